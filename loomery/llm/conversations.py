"""Conversation repair: the cheapest edits that make the roles alternate, the least of them by prefix doubling.

Rows get edits: Keep (0), Rerole to user or assistant (1), Delete (2, a must for
blank rows and for duplicates), and anywhere Insert of an empty user or assistant (5); a
truncated row that stays adds 5. What is left has role initials (s?(ua)+)?. The state of that
pattern is one of four (nothing yet, after s, after u, after a), and it settles
the role of an inserted or reroled row.

1. Rows are ordered by ranges and cut into blocks of bounded rows and bytes, so
   a conversation of any length is many blocks, each a row of a table.
2. Cost DP. Within a block the cost to go of a node (rows done, state) comes
   from the row after it. Between blocks a 4 x 4 matrix of least costs stands for a
   block; suffix products over the blocks of a conversation come by doubling.
3. Path ranking. Arcs that keep to the cost to go are optimal. Nodes are ranked by the
   least audit of 1, 2, 4, ... edits: the rank of length 2l is the rank of the pair
   (rank of length l here, rank of length l at the end of these l edits), and pointers double with it.
   Of a node's optimal arcs the one of least initial and then least rank is taken. The doubled pointers then give
   all nodes of the least path at once; from block to block they are maps of the
   four states, composed by doubling.
4. A pass in order renders the rows and hashes them as they come.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from loomery.llm.store import fields_and, written

BLANK, ENDINGS = " \t\n\x0b\x0c\r", (".", "!", "?")
#: Faults of a row in the order in which they count.
FINE, IS_BLANK, IS_DUPLICATE, IS_TRUNCATED = range(4)
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 2, 1, 5, 5
#: States: nothing yet, after s, after u, after a. Where an inserted or reroled row leads; where a kept initial leads (-1: nowhere).
NEXT = np.array([2, 2, 3, 2])
KEPT = {"s": [1, -1, -1, -1], "u": [2, 2, -1, 2], "a": [-1, -1, 3, -1]}
ROLE = {2: "user", 3: "assistant"}
#: Cost to go after the last row.
AT_END = np.array([0, 2 * INSERT_COST, INSERT_COST, 0])
FAR = 1 << 40
LETTERS = ("", "D", "I", "K", "R")


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: rows of conv_id, turn, role, text with faults by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row (gone), 1 empties its text, 2 removes its ``.!?``, 3 repeats it,
    4 sets role user. Nulls in role and text, and in what is hashed, are one space.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20).alias("kind")
    given = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind)
    text = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    each = given.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"))
    return each.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")


def own_fault(text: str) -> int:
    body = text.rstrip(BLANK)
    return IS_BLANK if not body else FINE if body.endswith(ENDINGS) else IS_TRUNCATED


def _costs(initials: np.ndarray, faults: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Cost to go (groups, rows + 1, 4) of groups of equally many rows, and the costs of the arcs D, I, K, R of each node."""
    groups, n = initials.shape
    cost = np.full((groups, n + 1, 4), FAR)
    arcs = [np.full((groups, n + 1, 4), FAR) for _ in "DIKR"]
    cost[:, n] = end
    for i in range(n - 1, -1, -1):
        after = np.concatenate([cost[:, i + 1], np.full((groups, 1), FAR)], axis=1)  # -1: nowhere
        stays = np.where(faults[:, i] == IS_TRUNCATED, TRUNCATED_COST, np.where(faults[:, i] == FINE, 0, FAR))[:, None]
        arcs[0][:, i] = after[:, :4] + DELETE_COST
        arcs[2][:, i] = np.take_along_axis(after, MOVES[initials[:, i]], axis=1) + stays
        arcs[3][:, i] = after[:, NEXT] + stays + REROLE_COST
        best = np.minimum(np.minimum(arcs[0][:, i], arcs[2][:, i]), arcs[3][:, i])
        for _ in range(2):  # two rows at most are worth inserting in one place
            best = np.minimum(best, best[:, NEXT] + INSERT_COST)
        cost[:, i] = best
        arcs[1][:, i] = best[:, NEXT] + INSERT_COST
    return cost, arcs


CODES = {"s": 0, "u": 1, "a": 2}
MOVES = np.array([*KEPT.values(), [-1] * 4])


def matrices(initials: np.ndarray, faults: np.ndarray) -> np.ndarray:
    """(groups, 4, 4): least cost from a state before the rows to one after them."""
    out = [_costs(initials, faults, np.where(np.arange(4) == q, 0, FAR)[None, :])[0][:, 0] for q in range(4)]
    return np.minimum(np.stack(out, axis=2), FAR)


def least_paths(initials: np.ndarray, faults: np.ndarray, end: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each group and first state: the least audit's codes (groups, 4, edits; 0 pads), the last state, the cost."""
    groups, n = initials.shape
    cost, arcs = _costs(initials, faults, end)
    arcs[1][last, n] = cost[last, n][:, NEXT] + INSERT_COST
    nodes = (n + 1) * 4
    node = np.arange(groups * nodes).reshape(groups, n + 1, 4)
    down = np.concatenate([node[:, 1:], node[:, -1:]], axis=1)
    moves = np.concatenate([MOVES[initials], np.zeros((groups, 1, 4), np.int64)], axis=1)
    target = [down, node[:, :, NEXT], np.take_along_axis(down, np.maximum(moves, 0), axis=2), down[:, :, NEXT]]
    optimal = np.stack([a == cost for a in arcs]).reshape(4, -1) & (cost.ravel() < FAR)
    to = np.stack([t.ravel() for t in target])

    def follow(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The optimal arc of least score: its initial's code (0: none) and where it leads."""
        best = np.where(optimal, score, np.iinfo(np.int64).max).argmin(axis=0)
        some = optimal.any(axis=0)
        return np.where(some, best + 1, 0), np.where(some, to[best, node.ravel()], node.ravel())

    initial = np.arange(4)[:, None]
    code, ahead = follow(np.broadcast_to(initial, optimal.shape))
    rank, length = code.astype(np.int64), 1
    while length < 3 * (n + 1):
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[ahead], return_inverse=True)[1]
        ahead, length = ahead[ahead], 2 * length
    code, ahead = follow(initial * len(rank) + rank[to])
    path = node[:, 0, :, None]
    reached = 1
    while reached < 3 * (n + 1):
        path = np.concatenate([path, ahead[path]], axis=2)
        ahead, reached = ahead[ahead], 2 * reached
    return code[path], path[:, :, -1] % 4, cost[:, 0]


def _blocks(block_rows: int, block_chars: int, conv_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order become blocks: at (their order), turns, roles, texts, and the faults that a row shows alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        chars, conv, begun = 0, None, False

        def close() -> pa.RecordBatch:
            nonlocal number, chars
            number += 1
            turns, roles, texts = (list(x) for x in zip(*held)) if held else ([], [], [])
            row = {"conv": pa.array([conv], conv_type), "at": pa.array([number], pa.int64()), "turns": pa.array([turns], pa.list_(pa.int64())), "roles": pa.array([roles], pa.list_(pa.string())), "texts": pa.array([texts], pa.list_(pa.string())), "faults": pa.array([[own_fault(t) for t in texts]], pa.list_(pa.int32()))}
            held.clear()
            chars = 0
            return pa.RecordBatch.from_pydict(row)

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal conv, begun, chars
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in range(5))):
                    if begun and (row[0] != conv or len(held) >= block_rows or chars >= block_chars):
                        yield close()
                    conv, begun = row[0], True
                    if not row[4]:
                        held.append(row[1:4])
                        chars += len(row[3])
            if begun:
                yield close()

        waiting: list[pa.RecordBatch] = []
        for block in packed():
            waiting.append(block)
            if len(waiting) >= 256 or sum(b.nbytes for b in waiting[-1:]) > block_chars:
                yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting = []
        if waiting:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]

    return run


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, initials' codes and faults of the blocks of each number of rows."""
    initials = [[CODES.get(r[:1], 3) for r in roles] for roles in batch.column("roles").to_pylist()]
    faults = batch.column("faults").to_pylist()
    sizes = np.array([len(f) for f in faults])
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        shape = (len(rows), int(n))
        yield rows, np.array([initials[i] for i in rows], np.int64).reshape(shape), np.array([faults[i] for i in rows], np.int64).reshape(shape)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, initials, faults in _by_size(batch):
            part = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([part.column("conv"), part.column("k"), pa.array(list(matrices(initials, faults).reshape(-1, 16)), pa.list_(pa.int64()))], ["conv", "k", "v"])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, initials, faults in _by_size(batch):
            part = batch.take(pa.array(rows))
            last = np.array(part.column("last").to_pylist(), bool)
            end = np.array([AT_END if e is None else e for e in part.column("end").to_pylist()], np.int64)
            codes, states, cost = least_paths(initials, faults, end, last)
            audits = [["".join([LETTERS[c] for c in path]) for path in four] for four in codes.tolist()]
            made = {"conv": part.column("conv"), "at": part.column("at"), "k": part.column("k"), "several": part.column("several"), "faults": part.column("faults")}
            made |= {"audits": pa.array(audits, pa.list_(pa.string())), "v": pa.array(states.tolist(), pa.list_(pa.int64())), "cost": pa.array(cost[:, 0], pa.int64())}
            yield pa.RecordBatch.from_pydict(made)


def _scanned(blocks: DataFrame, combine: Callable[[Column, Column], Column], step: int) -> DataFrame:
    """Running products of ``v`` over the blocks k of each conversation, by doubling: with those after (step 1) or before (step -1)."""
    now, most = written(blocks.select("conv", "k", "v"), "scan"), blocks.agg(F.max("k")).first()[0] or 0
    while abs(step) < most:
        other = now.select(F.col("conv").alias("c"), (F.col("k") - step).alias("j"), F.col("v").alias("w"))
        joined = now.join(other, F.col("conv").eqNullSafe(F.col("c")) & (F.col("k") == F.col("j")), "left")
        now, step = written(joined.select("conv", "k", F.when(F.col("w").isNull(), F.col("v")).otherwise(combine(F.col("v"), F.col("w"))).alias("v")), "scan"), 2 * step
    return now


def _product(v: Column, w: Column) -> Column:
    """Least costs over two stretches of rows."""
    cell = lambda x: F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda j: F.get(v, x - x % 4 + j) + F.get(w, j * 4 + x % 4)))
    return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda x: F.least(cell(x), F.lit(FAR)))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order, each after its audit: one row a conversation."""

    def start() -> dict:
        return {"digest": hashlib.sha256(), "lines": 0, "audit": [], "turns": 0, "low": None, "high": None, "turn": None, "role": None, "illegal": 0, "faults": [0] * 4, "cost": 0}

    def row(conv: object, s: dict) -> dict:
        gaps = s["high"] - s["low"] + 1 - s["turns"] if s["turns"] else 0
        blank, duplicate, truncated = s["faults"][1:]
        return {"conv": conv, "gaps": gaps, "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": s["illegal"], "cost": s["cost"], "audit": "".join(s["audit"]), "repaired_sha256": s["digest"].hexdigest()}

    conv, now, audit, state = None, None, "", 0
    done: list[dict] = []
    schema = None
    for batch in batches:
        schema = pa.schema([pa.field("conv", batch.schema.field("conv").type), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        for of, body, first, faults, cost, entry, found, turns, roles, texts in zip(*(batch.column(c).to_pylist() for c in ("conv", "body", "first", "faults", "cost", "entry", "audit", "turns", "roles", "texts"))):
            if now is None or of != conv:
                if now is not None:
                    done.append(row(conv, now))
                conv, now = of, start()
            if not body:
                audit, state = found, entry
                now["audit"].append(found)
                if first:
                    now["cost"] = cost
                for f in faults:
                    now["faults"][f] += 1
                continue
            for turn, role in zip(turns, roles):
                if now["role"] is not None:
                    now["illegal"] += now["role"][:1] + role[:1] not in ("su", "ua", "au")
                now["role"] = role
                if turn is not None:
                    now["turns"] += turn != now["turn"]
                    now["low"], now["high"], now["turn"] = turn if now["low"] is None else now["low"], turn, turn
            left = iter(zip(roles, texts))
            for edit in audit:
                role, text = ("", "") if edit == "I" else next(left)
                if edit == "D":
                    continue
                state = KEPT[role[:1]][state] if edit == "K" else int(NEXT[state])
                line = f"{role if edit == 'K' else ROLE[state]}:{text}"
                now["digest"].update(("\n" * (now["lines"] > 0) + line).encode())
                now["lines"] += 1
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done = []
    if now is not None:
        yield pa.RecordBatch.from_pylist([row(conv, now)], schema=schema)


def repair(turns: DataFrame, block_rows: int = 1024, block_chars: int = 1 << 20) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``turns`` has conv_id (any type that sorts), turn, role, text (nulls of the last two are one space), and may have gone
    (boolean): such rows only name their conversation. Rows go by turn, nulls
    first, then role and text. Null ids are one conversation. Faults count once a row, in the order blank,
    duplicate (role and text seen before), truncated. Ties of cost give the ASCII-least
    audit. A conversation without rows has zeros, an empty audit and the hash of nothing. A role
    that doesn't start with s, u or a, also an empty one, can't be kept. An empty table gives no rows; further columns are ignored.
    """
    gone = F.col("gone") if "gone" in turns.columns else F.lit(False)
    given = turns.select(F.col("conv_id").alias("conv"), F.col("turn").cast("bigint").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), F.coalesce(gone, F.lit(False)).alias("gone"))
    # equal rows may part anywhere, so that rows repeated very often fill no partition
    short = F.length("text") <= 64
    salt = F.when(short, F.abs(F.xxhash64(F.monotonically_increasing_id())) % (1 << 40)).otherwise(F.lit((1 << 63) - 1))
    ranged = given.withColumn("head", F.substring("text", 1, 64)).withColumn("salt", salt).repartitionByRange("conv", "turn", "role", "head", "salt")
    ordered = ranged.sortWithinPartitions("conv", "turn", "role", "text", "salt").select("conv", "turn", "role", "text", "gone")
    conv_field = T.StructField("conv", given.schema["conv"].dataType)
    schema = fields_and([conv_field], "at bigint, turns array<bigint>, roles array<string>, texts array<string>, faults array<int>")
    blocks = written(ordered.mapInArrow(_blocks(block_rows, block_chars, to_arrow_type(conv_field.dataType)), schema), "blocks")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("conv", "at", "i", "digest")}
            for conv, at, roles, texts in zip(*(batch.column(c).to_pylist() for c in ("conv", "at", "roles", "texts"))):
                out["conv"] += [conv] * len(roles)
                out["at"] += [at] * len(roles)
                out["i"] += range(len(roles))
                out["digest"] += [xxhash.xxh3_128_digest(f"{len(r)}:{r}{t}".encode()) for r, t in zip(roles, texts)]
            yield pa.RecordBatch.from_arrays([pa.array(out["conv"], batch.schema.field("conv").type), pa.array(out["at"], pa.int64()), pa.array(out["i"], pa.int32()), pa.array(out["digest"], pa.binary())], list(out))

    each = written(blocks.select("conv", "at", "roles", "texts").mapInArrow(digests, fields_and([conv_field], "at bigint, i int, digest binary")), "digests")
    seen = each.groupBy(F.col("conv").alias("c"), F.col("digest").alias("d")).agg(F.min(F.struct("at", "i")).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = each.join(seen, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))).where(F.struct("at", "i") > F.col("first"))
    repeats = again.groupBy("at").agg(F.collect_set("i").alias("repeats"))
    order = Window.partitionBy("conv").orderBy("at")
    faults = F.expr(f"transform(faults, (f, i) -> if(f <> {IS_BLANK} and array_contains(coalesce(repeats, array()), i), {IS_DUPLICATE}, f))")
    known = blocks.select("conv", "at", "roles", "faults").join(repeats, "at", "left").select("conv", "at", "roles", faults.alias("faults"), F.row_number().over(order).alias("k"), F.lead("at").over(order).isNull().alias("last"))
    known = written(known.withColumn("several", ~(F.col("last") & (F.col("k") == 1))), "known")
    several = known.where("several").select("conv", "k")
    long = not several.isEmpty()
    if long:
        made = known.where("several").select("conv", "k", "roles", "faults").mapInArrow(_matrices, fields_and([conv_field], "k int, v array<bigint>"))
        ends = ",".join(map(str, AT_END))
        to_go = F.expr(f"transform(sequence(0, 3), q -> array_min(transform(array({ends}), (e, j) -> v[q * 4 + j] + e)))")
        # the cost to go after a block is that before the next one
        after = _scanned(made, _product, 1).select(F.col("conv").alias("c"), (F.col("k") - 1).alias("j"), to_go.alias("end"))
        known = known.join(after, F.col("conv").eqNullSafe(F.col("c")) & (F.col("k") == F.col("j")), "left").drop("c", "j")
    else:
        known = known.withColumn("end", F.lit(None).cast("array<bigint>"))
    found = written(known.select("conv", "at", "k", "several", "last", "roles", "faults", "end").mapInArrow(_paths, fields_and([conv_field], "at bigint, k int, several boolean, faults array<int>, audits array<string>, v array<bigint>, cost bigint")), "paths")
    if long:
        maps = _scanned(found.where("several"), lambda v, w: F.transform(w, lambda q: F.get(v, q)), -1)
        # the state before a block is that after the one before it
        entry = maps.select(F.col("conv").alias("c"), (F.col("k") + 1).alias("j"), F.expr("v[0]").alias("entry"))
        found = found.join(entry, F.col("conv").eqNullSafe(F.col("c")) & (F.col("k") == F.col("j")), "left")
    else:
        found = found.withColumn("entry", F.lit(None).cast("bigint"))
    state = F.coalesce("entry", F.lit(0).cast("bigint"))
    audits = found.select("conv", "at", F.lit(False).alias("body"), (F.col("k") == 1).alias("first"), "faults", "cost", state.alias("entry"), F.get("audits", state.cast("int")).alias("audit"))
    both = audits.unionByName(blocks.select("conv", "at", F.lit(True).alias("body"), "turns", "roles", "texts"), allowMissingColumns=True)
    result = fields_and([conv_field], "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")
    return both.repartition("conv").sortWithinPartitions("conv", "at", "body").mapInArrow(_finish, result).withColumnRenamed("conv", "conv_id")
