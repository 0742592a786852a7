"""Suffix-array dedup: drop every byte of a long string that also stands elsewhere.

A string of ``length`` bytes is repeated where two suffixes of the corpus share
a prefix of that length. Suffixes are compared within shards:

1. Each window of ``length`` bytes has an anchor, the least hash of its grams.
   Equal windows have equal anchors, so a text falls into segments (runs of
   windows with one anchor), and only segments of one anchor need comparing.
   Segments that are the same bytes are one, with a count; one that is a string over
   and over is its first period, with a count of two.
2. Anchors that stand once are done. The other segments are dealt by anchor to
   shards of bounded bytes. A shard sorts its suffixes (by no more than the
   length), takes the Burrows-Wheeler transform, and expands intervals breadth
   first: the intervals of all strings of one more byte come by backward
   extension from those of the level before, so boundaries between suffixes
   are found in the order of the prefix they share. The expansion stops at the
   minimum length; suffixes without a boundary between them share it.
3. An anchor that many different segments hold (a passage in many
   documents, each with its own words around) would fill a shard. Its
   segments are taken as texts again, with longer grams: windows that hold more of their own
   words than a gram leaves out fall away. With grams as long as the window, windows of one
   anchor are one string, so every crowd ends.

Repeated windows go back to documents, which lose the bytes that these cover.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from loomery.llm.store import fields_and, written

CHUNK, MOST_STARTS = 1 << 18, 4096
KEY = ("k0", "k1", "k2")
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each run of ``gram`` bytes: two halves of a power of two, which overlap where they must."""
    now, size = data.astype(np.uint64), 1
    while size < gram:
        step = min(size, gram - size)
        # up to eight bytes fit as they are
        now = now[:-step] | now[step:] << np.uint64(8 * step) if size + step <= 8 and step == size else now[:-step] * A + now[step:]
        size += step
    now = (now ^ (now >> np.uint64(32))) * B
    return now ^ (now >> np.uint64(29))


def sliding(pick: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """The least or largest value of each ``width`` neighbours; ``pick`` is np.minimum or np.maximum."""
    size = 1
    while size < width:
        step = min(size, width - size)
        x = pick(x[:-step], x[step:])
        size += step
    return x


def packs(texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts laid end to end, some ``CHUNK`` bytes at a time: (bytes, text of each part, its first byte there, its offset in the text). Longer texts come in parts that overlap by a window less one."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def out() -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        ends = np.cumsum([len(d) for _, _, d in held])
        return b"".join([d for _, _, d in held]), np.array([i for i, _, _ in held]), ends - [len(d) for _, _, d in held], np.array([at for _, at, _ in held])

    for i, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, CHUNK):
            held.append((i, at, text[at : at + CHUNK + length - 1]))
            size += len(held[-1][2])
            if size >= CHUNK:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def segments(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, anchor, first start, number of starts, again, period) of the runs of windows with one anchor, in order; very long runs are cut.

    again: the anchor stands more than once thereabouts, so that a run's own windows may repeat each other. period: where a run is a
    string over and over, the length of that string, else 0; such a stretch within a run is cut out as one.
    """
    for data, text, start, offset in packs(texts, length):
        hashes, width = gram_hashes(np.frombuffer(data, np.uint8), gram), length - gram + 1
        low = sliding(np.minimum, hashes, width)
        edge = np.zeros(width - 1, np.uint64)
        held = np.sort(hashes[hashes == sliding(np.maximum, np.concatenate([edge, low, edge]), width)])  # all places of anchors
        # windows over the end of a part belong to no text
        stop = np.append(start[1:], len(data)) - length + 1
        border = np.zeros(len(low) + 1, bool)
        border[[*start, *stop]] = True
        border[1:-1] |= low[1:] != low[:-1]
        first = np.flatnonzero(border[:-1])
        size = np.diff(np.append(first, len(low)))
        part = np.searchsorted(start, first, side="right") - 1
        inside = first < stop[part]
        first, size, part = first[inside], size[inside], part[inside]
        cuts = (size - 1) // MOST_STARTS + 1
        if (cuts > 1).any():
            nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            end, part = np.repeat(first + size, cuts), np.repeat(part, cuts)
            first = np.repeat(first, cuts) + nth * MOST_STARTS
            size = np.minimum(end - first, MOST_STARTS)
        again, period = np.isin(low[first], held[1:][held[1:] == held[:-1]]), np.zeros(len(first), np.int64)
        whole, rows = np.frombuffer(data, np.uint8), [first, size, part, again, period]
        cut = [(i, *found) for i in np.flatnonzero(again).tolist() if (found := stretch(whole[first[i] : first[i] + size[i] + length - 1], np.flatnonzero(hashes[first[i] : first[i] + size[i] + width - 1] == low[first[i]]), length))]
        if cut:
            # what stands before and after a stretch are runs of their own
            made = [(int(first[i]) + x, y - x, int(part[i]), not d, d) for i, a, b, d in cut for x, y, d in ((0, a, 0), (a, b, d), (b, int(size[i]), 0)) if y > x]
            rows = [np.concatenate([np.delete(old, [c[0] for c in cut]), np.array(new, old.dtype)]) for old, new in zip(rows, zip(*made))]
            order = np.argsort(rows[0])
            rows = [r[order] for r in rows]
        first, size, part, again, period = rows
        yield text[part], low[first], first - start[part] + offset[part], size, again, period


def stretch(body: np.ndarray, places: np.ndarray, length: int) -> tuple[int, int, int] | None:
    """(first window, end, period) of the longest stretch in which a string stands over and over, twice in windows at least; ``places`` are those of a gram in it."""
    best = None
    middle = len(places) // 2
    for d in sorted(set((places[middle + 1 : middle + 9] - places[middle]).tolist())) if len(places) > 1 else ():
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (body[d:] == body[:-d]).astype(np.int8), [0]])))
        longest = int((edge[1::2] - edge[::2]).argmax()) if len(edge) else 0
        a, b = (int(edge[2 * longest]), int(edge[2 * longest + 1]) + d - length + 1) if len(edge) else (0, 0)
        if b - a >= 2 * d and (best is None or b - a > best[1] - best[0]):
            best = (a, b, d)
    return best


def suffix_order(code: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by ``depth`` symbols at least; ``code`` has symbols under 512 and a unique least one at its end."""
    n, pad = len(code), 7
    padded = np.concatenate([code, np.zeros(pad, code.dtype)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for j in range(pad):
        key = key << 9 | padded[j : n + j]
    order = np.argsort(key)
    ordered, known = key[order], pad
    # a rank is the first place of its group, so groups that are told apart keep theirs and leave the later rounds
    places = np.arange(n)
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, places, 0))
    while known < depth:
        open_ = ~(new & np.append(new[1:], True))
        places, part = places[open_], order[places[open_]]
        if not len(part):
            break
        beyond = part + known
        ahead = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        key = rank[part] * (n + 1) + ahead
        by_key = np.argsort(key)
        part, ordered = part[by_key], key[by_key]
        order[places] = part
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        rank[part] = np.maximum.accumulate(np.where(new, places, 0))
        known *= 2
    return order


def boundaries(code: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place of the suffix order, whether its suffix shares fewer than ``length`` symbols with the one before.

    Breadth-first backward extension on the Burrows-Wheeler transform: level l
    holds the intervals of strings of l symbols whose end was new. Their
    extensions by one symbol end at a boundary of prefix l, unless it is known.
    """
    n = len(code)
    bwt = code[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    back = np.empty(n, np.int64)  # where the suffix that is one symbol longer stands
    back[by_symbol] = np.arange(n)
    same = bwt[by_symbol[1:]] == bwt[by_symbol[:-1]]
    before, after = np.full(n, -1, np.int64), np.full(n, n, np.int64)
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    ends = np.cumsum(np.bincount(bwt))
    ends = ends[np.concatenate([ends[:1] > 0, ends[1:] != ends[:-1]])]
    low, high = np.concatenate([[0], ends[:-1]]), ends
    fresh = ~known[high]
    known[high] = True
    low, high = low[fresh], high[fresh]
    for _ in range(1, length):
        if not len(low):
            break
        size = high - low
        start = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(low - start, size)
        # the first and the last place of a symbol within an interval give the ends of its extension; these don't overlap, so both sort alike
        new_low = np.sort(back[at[before[at] < np.repeat(low, size)]])
        new_high = np.sort(back[at[after[at] >= np.repeat(high, size)]]) + 1
        fresh = ~known[new_high]
        low, high = new_low[fresh], new_high[fresh]
        known[high] = True
    return known[:n]


def repeated_windows(texts: list[bytes], sure: np.ndarray, length: int) -> list[np.ndarray]:
    """For each text, whether the window at each start is repeated; in ``sure`` texts all are."""
    size = np.array([len(t) for t in texts], np.int64)
    whole = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    ends = np.cumsum(size + 1) - 1
    code = whole.astype(np.uint16) + 2
    code[ends] = 1
    code = np.append(code, np.uint16(0))
    owner = np.repeat(np.arange(len(texts)), size + 1)
    full = np.append(ends[owner] - np.arange(len(owner)) >= length, False)
    owner = np.append(owner, 0)
    order = suffix_order(code, length)
    group = np.cumsum(boundaries(code, order, length)) - 1
    many = np.bincount(group[full[order]], minlength=int(group[-1]) + 1) > 1
    certain = np.bincount(group, weights=(full & sure[owner])[order], minlength=len(many)) > 0
    out = np.zeros(len(code), bool)
    out[order] = (many | certain)[group]
    out &= full
    starts = ends - size
    return [out[a : a + max(0, n - length + 1)] for a, n in zip(starts, size)]


def runs_of(marks: np.ndarray) -> list[dict[str, int]]:
    """Runs of true values as {low, high}, high exclusive."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return [{"low": int(a), "high": int(b)} for a, b in zip(edge[::2], edge[1::2])]


RUNS = "array<struct<low:bigint,high:bigint>>"


def repeated(texts: DataFrame, length: int, grams: tuple[int, ...], shard_bytes: int) -> DataFrame:
    """(k0, k1, k2, runs): runs of starts whose window stands elsewhere too.

    ``texts`` has k0, k1, k2 (bigint; rows that share them hold the same bytes), data
    (binary) and weight (how many places hold it).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                texts = part.column(3).to_pylist()
                keys = [part.column(c).to_numpy() for c in (0, 1, 2, 4)]
                for text, anchor, first, count, again, period in segments(texts, length, grams[0]):
                    # each window of a string over and over stands there twice at least, and its first period has all of them
                    body = np.where(period > 0, period, count)
                    ends = (first + body + length - 1).tolist()
                    s = np.frombuffer(b"".join([digest(texts[i][a:b]) for i, a, b in zip(text.tolist(), first.tolist(), ends)]), "<i8").reshape(-1, 2)
                    own = [k[text] for k in keys]
                    own[3] = own[3] * np.where(period > 0, 2, 1)
                    arrays = [*own, first, count.astype(np.int32), body.astype(np.int32), anchor.view(np.int64), s[:, 0].copy(), s[:, 1].copy(), again]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], placed_in.names)

    placed_in = fields_and([], "k0 bigint, k1 bigint, k2 bigint, weight bigint, start bigint, n int, body int, anchor bigint, s1 bigint, s2 bigint, again boolean")
    places = written(texts.select(*KEY, "data", "weight").mapInArrow(cut, placed_in), "places")
    kinds = places.groupBy("anchor", "s1", "s2").agg(F.sum("weight").alias("total"), F.max("again").alias("again"), F.min(F.struct(*KEY, "start", F.col("body").alias("n"))).alias("at"))
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("total").alias("all"), F.max("again").alias("any"), F.sum(F.col("at.n") + length - 1).alias("bytes")).where("all > 1 or any").drop("any")
    # a segment that stands twice is repeated as a whole; one without others of its anchor needs no comparing
    shared = written(kinds.join(anchors.select("anchor", "kinds", "bytes"), "anchor"), "kinds")
    whole = shared.where("total > 1").select("anchor", "s1", "s2", F.lit(None).cast(RUNS).alias("runs"))

    wanted = shared.where("kinds > 1 or total = 1").select(*[F.col(f"at.{c}").alias(c) for c in KEY], F.struct(F.col("at.start").alias("start"), F.col("at.n").alias("n"), "anchor", "s1", "s2", "total", (F.col("bytes") > shard_bytes).alias("hot")).alias("one"))
    lists = wanted.groupBy(*KEY).agg(F.sort_array(F.collect_list("one")).alias("all"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for i in range(len(batch)):
                key = tuple(batch.column(c)[i].as_py() for c in range(3))
                if key == last:  # repeated rows
                    continue
                last, data = key, batch.column(3)[i].as_py()
                rows = batch.column(4)[i].as_py()
                bodies = [data[r["start"] : r["start"] + r["n"] + length - 1] for r in rows]
                yield pa.RecordBatch.from_pydict({c: [r[c] for r in rows] for c in ("anchor", "s1", "s2", "total", "hot")} | {"body": bodies}, schema=arrow)

    arrow = pa.schema([("anchor", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("total", pa.int64()), ("hot", pa.bool_()), ("body", pa.binary())])
    bodies = written(texts.select(*KEY, "data").join(lists, list(KEY)).select(*KEY, "data", "all").mapInArrow(take, "anchor bigint, s1 bigint, s2 bigint, total bigint, hot boolean, body binary"), "bodies")
    load = bodies.agg(F.sum(F.expr("if(hot, 0, length(body))")).alias("usual"), F.max("hot").alias("hot")).first()
    shards = max(1, math.ceil((load["usual"] or 0) / shard_bytes))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["s1", "s2"])
        marks = repeated_windows(pdf.body.tolist(), pdf.total.to_numpy() > 1, length)
        out = pdf[["anchor", "s1", "s2"]].assign(runs=[runs_of(m) for m in marks])
        return out[(pdf.total.to_numpy() == 1) & np.array([len(r) > 0 for r in out.runs], bool)]

    usual = bodies.where("not hot").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    found = whole.unionByName(usual.groupBy("shard").applyInPandas(compare, f"anchor bigint, s1 bigint, s2 bigint, runs {RUNS}"))
    if load["hot"]:
        crowd = bodies.where("hot").dropDuplicates(["anchor", "s1", "s2"]).select(F.col("anchor").alias("k0"), F.col("s1").alias("k1"), F.col("s2").alias("k2"), F.col("body").alias("data"), F.col("total").alias("weight"))
        deeper = repeated(written(crowd, "crowd"), length, grams[1:] or (length,), shard_bytes).select(F.col("k0").alias("anchor"), F.col("k1").alias("s1"), F.col("k2").alias("s2"), "runs")
        alone = bodies.where("hot and total = 1").select("anchor", "s1", "s2").distinct()
        found = found.unionByName(deeper.join(alone, ["anchor", "s1", "s2"], "left_semi"))
    runs = written(found, "runs")
    shifted = F.transform("runs", lambda r: F.struct((r.low + F.col("start")).alias("low"), (r.high + F.col("start")).alias("high")))
    own = F.array(F.struct(F.col("start").alias("low"), (F.col("start") + F.col("n")).alias("high")))
    back = places.join(runs, ["anchor", "s1", "s2"]).select(*KEY, F.explode(F.when(F.col("runs").isNull(), own).otherwise(shifted)).alias("run"))
    return back.groupBy(*KEY).agg(F.sort_array(F.collect_set("run")).alias("runs"))


def covered(runs: list[dict[str, int]], length: int) -> list[tuple[int, int]]:
    """Maximal spans of bytes that the windows at sorted runs of starts cover."""
    spans: list[list[int]] = []
    for r in runs:
        low, high = r["low"], r["high"] - 1 + length
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high)
        else:
            spans.append([low, high])
    return [tuple(s) for s in spans]


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, grams: tuple[int, ...] = (64, 256, 384), shard_bytes: int = 1 << 20, digest_only: bool = False) -> DataFrame:
    """Remove each byte that a string of ``length`` bytes covers which also starts anywhere else.

    Returns per input row: row (struct of all input columns), doc_id, n_bytes,
    n_removed, spans (removed byte ranges, end exclusive), kept (binary: the bytes left, which may
    cut a character; with ``digest_only`` their SHA-256 in lowercase hex, and row is left out).
    Texts are UTF-8 bytes, matches never cross rows, overlaps with itself count, and repeats are judged on the
    input, not on what is left: all places of a repeated string go. Nulls are empty texts. Repeated rows are places of their own, as are rows without an id. An
    empty table gives no rows; input columns of any name are carried inside ``row``. ``grams`` are
    the lengths of anchor grams, longer ones for crowded anchors; none may exceed ``length``.
    """
    own = [] if digest_only else [F.struct("*").alias("row")]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = [F.xxhash64(F.col(id_col).cast("string")).alias("k0"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]
    given = docs.select(*own, F.col(id_col).alias("doc_id"), text.cast("binary").alias("data"), *key)
    long = given.where(F.length("data") >= length).withColumn("weight", F.lit(1).cast("bigint"))
    runs = repeated(long, length, tuple(min(g, length) for g in grams), shard_bytes)
    joined = given.join(runs, list(KEY), "left").select(*["row"] * (not digest_only), "doc_id", "data", "runs")
    kind = "string" if digest_only else "binary"
    schema = fields_and([f for f in joined.schema.fields if f.name in ("row", "doc_id")], f"n_bytes bigint, n_removed bigint, spans {RUNS}, kept {kind}")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                n, gone, spans, kept = [], [], [], []
                for data, runs in zip(part.column("data").to_pylist(), part.column("runs").to_pylist()):
                    cut = covered(runs or [], length)
                    edges = [0, *(x for span in cut for x in span), len(data)]
                    left = b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2])])
                    n.append(len(data))
                    gone.append(len(data) - len(left))
                    spans.append([{"low": a, "high": b} for a, b in cut])
                    kept.append(hashlib.sha256(left).hexdigest() if digest_only else left)
                out = {f: part.column(f) for f in schema.fieldNames() if f in ("row", "doc_id")}
                out |= {"n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "spans": pa.array(spans, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))), "kept": pa.array(kept, pa.string() if digest_only else pa.binary())}
                yield pa.RecordBatch.from_pydict(out)

    return joined.mapInArrow(drop, schema)
