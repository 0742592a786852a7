"""SimHash near-duplicates by anchor-point covering.

Two 64-bit fingerprints at most two bits apart are at most one bit apart in one
of two 31-bit halves (bits 0-30 and 31-61; bits 62 and 63 only count in the
final comparison). The perfect Hamming code of length 31 covers each half with
radius 1: its codewords are the anchors. Every fingerprint is at home at the one
anchor within the covering radius, and is replicated to all anchors within
radius plus threshold (1 + 1): at most 16 a half. A pair one bit apart in a half
always meets at either's home, so nothing is missed, and 2**26 anchors a half
keep the lists short.

An anchor at home for more than ``crowd`` distinct fingerprints is not compared
pair by pair. Its fingerprints go to all 65 points within one bit of them; those
that share a point are at most two bits apart, and each is linked with the
smallest there. That keeps every component, at a cost linear in the crowd.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from loomery.llm.components import components
from loomery.llm.store import written

SEED = 42
HALF_BITS = 31
BLOCK = 1 << 16


def shingle_hashes(text: bytes | None, words_per_shingle: int) -> np.ndarray:
    """Hashes of the word shingles of UTF-8 text in their order; a shorter text is one shingle, a wordless one has none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, n = b" ".join(words), len(words)
    if n < words_per_shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        size = np.fromiter(map(len, words), np.int64, n) + 1
        end = np.cumsum(size) - 1
        start = end - size + 1
        last = words_per_shingle - 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[i:j], SEED) for i, j in zip(start[: n - last].tolist(), end[last:].tolist())]
    return np.array(hashes, np.uint64)


def fingerprint_of(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes | None, words_per_shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of UTF-8 text; 0 where there is no word."""
    return fingerprint_of(shingle_hashes(text, words_per_shingle))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """(doc_id, fp bigint) for every row; a null or wordless text has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, words_per_shingle) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            fp = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], ["doc_id", "fp"])

    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id bigint, fp bigint")


def anchors_of(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors within two bits of each 31-bit word: (row, anchor, whether it is the row's home)."""
    syndrome = np.zeros(len(half), np.int64)
    for i in range(1, HALF_BITS + 1):
        syndrome ^= np.where((half >> (i - 1)) & 1, i, 0)
    bit = np.concatenate([[0], 1 << np.arange(HALF_BITS)]).astype(np.int64)  # bit[0]: flip nothing
    rows, words, homes = [np.arange(len(half))], [half ^ bit[syndrome]], [np.ones(len(half), bool)]
    for i in range(1, HALF_BITS + 1):
        j = i ^ syndrome
        at = np.flatnonzero((syndrome != 0) & (j > i))
        rows.append(at)
        words.append(half[at] ^ bit[i] ^ bit[j[at]])
        homes.append(np.zeros(len(at), bool))
    return np.concatenate(rows), np.concatenate(words), np.concatenate(homes)


def _replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mask = (1 << HALF_BITS) - 1
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        for side in (0, 1):
            row, word, home = anchors_of((fp >> (HALF_BITS * side)) & mask)
            yield pa.RecordBatch.from_arrays([pa.array(word | side << HALF_BITS), pa.array(fp[row]), pa.array(home)], ["anchor", "fp", "home"])


def _near_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate([[0], 1 << np.arange(64, dtype=np.uint64)]).astype(np.uint64).view(np.int64)
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array((fp[:, None] ^ flips).ravel()), pa.array(np.repeat(fp, 65))], ["point", "fp"])


def links(distinct: DataFrame, crowd: int = 256) -> DataFrame:
    """Links (a, b) whose components are those of all pairs at most two bits apart.

    ``distinct`` has one row a fingerprint (fp bigint). Outside crowds every such
    pair is a row; inside, each shared point gives a star.
    """
    placed = written(distinct.select("fp").mapInArrow(_replicas, "anchor bigint, fp bigint, home boolean"), "anchors")
    hot = written(placed.where("home").groupBy("anchor").count().where(F.col("count") > crowd).select("anchor"), "hot")
    usual = placed.join(hot, "anchor", "left_anti")
    home = usual.where("home").select("anchor", F.col("fp").alias("a"))
    near = usual.select("anchor", F.col("fp").alias("b"))
    pairs = home.join(near, "anchor").where("a <> b and bit_count(a ^ b) <= 2").select("a", "b")
    crowded = placed.join(hot, "anchor", "left_semi").select("fp").distinct()
    points = crowded.mapInArrow(_near_points, "point bigint, fp bigint")
    # every member of a crowded point is linked with the smallest; singles drop out as a = b
    low = points.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z").select("point", "a")
    stars = points.join(low, "point").where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, crowd: int = 256) -> DataFrame:
    """One row per input row: doc_id, fp (bigint), component_id.

    component_id is the smallest doc_id reachable by links between fingerprints
    at most two bits apart. Null, empty and wordless texts share fingerprint 0
    and link like any other; repeated rows give repeated results; a null doc_id
    is kept and never is a component's smallest (null only where all are). An
    empty table gives no rows; further columns are ignored.
    """
    each = written(fingerprints(docs, id_col, text_col, words_per_shingle), "fingerprints")
    distinct = written(each.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    roots = components(links(distinct, crowd), "a", "b").withColumnRenamed("node", "fp")
    classes = written(distinct.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "classes")
    least = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    of = written(classes.join(least, "root").select("fp", "component_id"), "members")
    return each.join(of, "fp").select("doc_id", "fp", "component_id")
