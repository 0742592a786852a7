"""Near copies by SimHash links and the exact Jaccard similarity of word shingles.

Two sets of similarity t or more share an element among the first n - ceil(t n) + 1
of each, in any order that is the same for all sets. So only these prefixes are
joined; elements that one set alone holds drop out before. The places of the shared
elements bound how much two sets can have in common. Pairs that the bound leaves are
compared by sketches: the parity of each bucket of a set's elements, about a bit an
element. Buckets of different parity are at most as many as the elements that one set
alone holds, so a pair with too many is none, and few others remain. These are
compared by their whole sets, and only their sets are made and moved: nothing is missed
and nothing unverified is linked. The order puts elements last that are common in a sample of documents; the
sample shapes the prefixes, not the result.

An element in the prefixes of more than ``crowd`` sets is not compared pair by pair
at once. Rounds compare its sets with one of them, and only pairs that the links
found so far leave in different components are compared after that. A crowd of
sets that share a prefix element without being near each other costs its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from loomery.llm import simhash
from loomery.llm.components import components
from loomery.llm.simhash import SEED, fingerprint_of, shingle_hashes
from loomery.llm.store import few, written

#: The similarity from which two sets are near copies, as a fraction.
OVER, UNDER = 4, 5
SAMPLE, MOST_COMMON, ROUNDS = 30_000, 200_000, 3
#: Buckets of a sketch. More elements only tell less apart.
FEWEST, MOST = 1 << 6, 1 << 16
#: Bits of a filter that keeps most rows without a partner from being moved; a full one only moves more.
SLOTS = 1 << 25
SIZES_FIT = f"{UNDER} * least(a.n, b.n) >= {OVER} * greatest(a.n, b.n)"


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def node_of(shingles: np.ndarray) -> int | None:
    """The signed key of a set; None for the empty one."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64)) if len(shingles) else None


def prefix(shingles: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The elements of which a near copy has one at least in its own prefix."""
    rank = np.zeros(len(shingles), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        rank = np.where(common[at] == shingles, counts[at], 0)
    n = len(shingles)
    return shingles[np.lexsort((shingles, rank))[: n + OVER * n // -UNDER + 1]]


def sketch_of(shingles: np.ndarray) -> bytes:
    """A bit for each of the buckets, at least as many as elements up to ``MOST``: whether it holds an odd number of elements."""
    buckets = min(max(FEWEST, 1 << max(len(shingles) - 1, 0).bit_length()), MOST)
    held = np.bincount((shingles & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.packbits((held & 1).astype(np.uint8), bitorder="little").tobytes()


def apart_at_least(x: bytes, y: bytes) -> int:
    """How many elements one of two sets alone holds at least, by their sketches."""
    short, long = sorted((x, y), key=len)
    a, b, bits = int.from_bytes(short, "little"), int.from_bytes(long, "little"), 8 * len(long)
    while bits > 8 * len(short):  # buckets whose low bits agree become one
        bits //= 2
        b = (b >> bits) ^ (b & ((1 << bits) - 1))
    return (a ^ b).bit_count()


def may_be_near(n_a: int, n_b: int, x: bytes, y: bytes) -> bool:
    return (OVER + UNDER) * apart_at_least(x, y) <= (UNDER - OVER) * (n_a + n_b)


def near(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return UNDER * both >= OVER * (len(a) + len(b) - both)


def common_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Elements that several documents of a bounded sample hold, in order, and how many do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0).cast(pa.binary()).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t, words).view(np.int64))], ["token"])

    share = int(min(1.0, SAMPLE / max(docs.count(), 1)) * (1 << 20))
    drawn = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).select("text")
    found = drawn.mapInArrow(run, "token bigint").groupBy("token").count().where("count > 1").orderBy(F.desc("count"), "token").limit(MOST_COMMON).toArrow()
    token = found.column("token").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], found.column("count").to_numpy()[order]


def described(docs: DataFrame, words: int = 5) -> DataFrame:
    """row, doc_id, hash, fp, node, n, prefix, sketch of each row (doc_id bigint, text string); hash is the text's, node is null for a wordless one."""
    common, counts = common_shingles(docs, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            hashes = [shingle_hashes(t.as_py(), words) for t in batch.column(3).cast(pa.binary())]
            sets = list(map(np.unique, hashes))
            fp = np.array(list(map(fingerprint_of, hashes)), np.uint64).view(np.int64)
            heads = [prefix(s, common, counts).view(np.int64) for s in sets]
            ends = np.cumsum([0, *map(len, heads)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *heads])))
            columns = [pa.array(fp), pa.array(map(node_of, sets), pa.int64()), pa.array(list(map(len, sets)), pa.int32()), lists, pa.array(map(sketch_of, sets), pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["row", "doc_id", "hash", "fp", "node", "n", "prefix", "sketch"])

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("hash"), "text")
    return numbered.mapInArrow(run, "row bigint, doc_id bigint, hash bigint, fp bigint, node bigint, n int, prefix array<bigint>, sketch binary")


def _filter_of(keys: DataFrame) -> np.ndarray:
    """Bitmap of the hashes in the only column of ``keys``; of fixed size, whatever their number."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.zeros(SLOTS // 8, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy() & (SLOTS - 1)
            np.bitwise_or.at(there, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([there.tobytes()], pa.binary())], ["bits"])

    bits = np.zeros(SLOTS // 8, np.uint8)
    for r in keys.coalesce(8).mapInArrow(marks, "bits binary").toLocalIterator():
        bits |= np.frombuffer(r["bits"], np.uint8)
    return bits


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & (SLOTS - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _members(sets: DataFrame, crowd: int) -> DataFrame:
    """token, node, n, pos, held, hot of prefix elements that several sets hold; hot counts a set's elements that a crowd holds."""
    held = sets.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    held = written(held, "shared")
    bits = sets.sparkSession.sparkContext.broadcast(_filter_of(held.select("token")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, sizes = batch.column(2).flatten().to_numpy(), batch.column(2).value_lengths().to_numpy()
            of = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = np.flatnonzero(_passes(bits.value, tokens))
            yield pa.RecordBatch.from_arrays([pa.array(tokens[keep]), batch.column(0).take(pa.array(of[keep])), batch.column(1).take(pa.array(of[keep])), pa.array(pos[keep], pa.int32())], ["token", "node", "n", "pos"])

    found = written(sets.select("node", "n", "prefix").mapInArrow(run, "token bigint, node bigint, n int, pos int").join(held, "token"), "members")
    hot = found.where(F.col("held") > crowd).groupBy("node").agg(F.count("*").cast("int").alias("hot"))
    return written(found.join(hot, "node", "left").select("token", "node", "n", "pos", "held", F.coalesce("hot", F.lit(0)).alias("hot")), "hot-members")


def _sets_of(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node, shingles (binary) of the given nodes (node, hash of a text of theirs). A filter of fixed size passes over most other texts."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter_of(nodes.select("hash")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            wanted = np.flatnonzero(_passes(bits.value, batch.column(0).to_numpy()))
            sets = [shingle_set(t.as_py(), words) for t in batch.column(1).take(pa.array(wanted)).cast(pa.binary())]
            arrays = [pa.array(map(node_of, sets), pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "shingles"])

    made = docs.select(F.xxhash64("text").alias("hash"), "text").mapInArrow(run, "node bigint, shingles binary")
    return made.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _in_reach(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets that share elements, and that the places of these let be near copies."""
    pairs = members.alias("a").join(members.alias("b"), F.expr(f"a.token = b.token and a.node < b.node and {SIZES_FIT}"))
    each = pairs.groupBy(F.col("a.node").alias("a"), F.col("b.node").alias("b")).agg(
        F.count("*").alias("shared"), *(F.max(f"{s}.{c}").alias(f"{c}_{s}") for s in "ab" for c in ("n", "pos", "hot"))
    )
    # up to the last shared place all that both hold is counted; elements of crowds aren't, so they may all be shared
    most = F.expr("shared + least(hot_a, hot_b) + least(n_a - pos_a, n_b - pos_b) - 1")
    return each.where(most * (OVER + UNDER) >= F.expr("n_a + n_b") * OVER).select("a", "b")


def _both(pairs: DataFrame, of: DataFrame, *columns: str) -> DataFrame:
    """a, b and the columns of either, those of b with a 2 behind."""
    first = of.select(F.col("node").alias("a"), *columns)
    second = of.select(F.col("node").alias("b"), *(F.col(c).alias(f"{c}2") for c in columns))
    return pairs.join(first, "a").join(second, "b").select("a", "b", *columns, *(f"{c}2" for c in columns))


def _alike(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that their sketches let be near copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, x, n_b, y = (batch.column(i).to_pylist() for i in range(2, 6))
            yield batch.select(["a", "b"]).filter(pa.array(list(map(may_be_near, n_a, n_b, x, y)), pa.bool_()))

    return _both(pairs, sketches, "n", "sketch").mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """Those of the pairs (a, b) that are near copies by their whole sets."""
    alike = written(_alike(pairs, sketches), "alike")
    if alike.isEmpty():
        return alike
    ends = alike.select(F.col("a").alias("node")).union(alike.select("b")).distinct()
    sets = written(_sets_of(docs, written(sketches.join(ends, "node", "left_semi").select("node", "hash"), "nodes"), words), "sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [near(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return written(_both(alike, sets, "shingles").mapInArrow(run, "a bigint, b bigint"), "near")


def links(docs: DataFrame, each: DataFrame, crowd: int = 32, words: int = 5) -> DataFrame:
    """Links (a, b) between nodes whose components are those of all pairs of near copies.

    ``docs`` is (doc_id, text) and ``each`` what ``described`` gives for it.
    """
    some = each.where("node is not null")
    one = some.groupBy("node").agg(F.min("row").alias("row"))
    ones = some.join(one, ["node", "row"], "left_semi")
    members = _members(ones.select("node", "n", "prefix"), crowd)
    near_by = written(_in_reach(members.where(F.col("held") <= crowd)), "pairs")
    crowds = members.where(F.col("held") > crowd).select("token", "node", "n")
    nodes = near_by.select(F.col("a").alias("node")).union(near_by.select("b")).union(crowds.select("node")).distinct()
    sketches = written(ones.select("node", "hash", "n", "sketch").join(nodes, "node", "left_semi"), "sketches")

    found = _verified(near_by, sketches, docs, words)
    for k in range(ROUNDS + 1):
        roots = components(found, "a", "b")
        at = written(crowds.join(roots, "node", "left").select("token", "node", "n", F.coalesce("root", "node").alias("root")), "crowds")
        lead = F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), "node", "n", "root")).alias("b")
        split = at.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), lead).where("low <> high")
        split = written(split.select("token", "b"), "split")
        if split.isEmpty():
            break
        if k < ROUNDS:
            pairs = at.alias("a").join(split, "token").where(f"a.root <> b.root and {SIZES_FIT}").select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b"))
        else:
            apart = at.join(split.select("token"), "token", "left_semi")
            pairs = apart.alias("a").join(apart.alias("b"), F.expr(f"a.token = b.token and a.root < b.root and {SIZES_FIT}"))
            pairs = pairs.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b"))
        found = found.unionByName(_verified(pairs.distinct(), sketches, docs, words))
    return found


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = 32, words: int = 5) -> DataFrame:
    """One row per input row: doc_id, component_id, as ``simhash.near_duplicates`` gives them.

    Links are its own (fingerprints at most two bits apart, here of five-word shingles)
    and all pairs whose five-word shingles have similarity 0.8 or more.
    """
    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    each = written(described(given, words), "described")
    prints = simhash.links(each.select("fp").distinct())
    # a row ties its fingerprint to its set; both are 64-bit hashes
    ties = each.where("node is not null").select(F.col("fp").alias("a"), F.col("node").alias("b")).distinct()
    edges = prints.unionByName(links(given, each, crowd, words)).unionByName(ties)
    roots = components(edges, "a", "b").withColumnRenamed("node", "fp")
    classes = written(each.groupBy("fp").agg(F.min("doc_id").alias("low")).join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "classes")
    of = written(classes.join(classes.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("fp", "component_id"), "members")
    return each.join(of, "fp").select("doc_id", "component_id")
