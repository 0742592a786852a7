"""Line dedup: documents probe sharded minimal perfect hashes of their lines.

1. Every line becomes a 128-bit hash of its key. A shuffle with partial sums
   keeps, for each distinct hash, its smallest doc_id and its count.
2. The distinct hashes are dealt to shards. Each shard builds a minimal perfect
   hash (levels of bit arrays, rank by prefix popcounts) that indexes three flat
   arrays: 64-bit fingerprint, count, and first document.
3. Documents probe the arrays: (document, hash) probes are routed to shards, a
   shard with a very common line is served by several copies of its arrays, and
   only hits come back: lines counted more than once whose first document is
   another. Lines themselves are never shuffled or joined.

Every probe is a key of the index, so the 128-bit hash alone finds its slot; the
fingerprint there guards against arrays of another state.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from loomery.llm.store import few, fields_and, written

BLANK = b" \t\n\x0b\x0c\r"
GAMMA, MAX_LEVELS = 2.0, 40


def line_keys(text: bytes | None, min_chars: int = 10) -> list[bytes | None]:
    """Digest of each line's key, None for keys under ``min_chars`` code points."""
    out: list[bytes | None] = []
    for line in (text or b"").lower().split(b"\n"):
        key = line.strip(BLANK)
        long = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


def _mixed(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h1 + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) ^ (h2 * np.uint64(2 * level + 1))


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys: a few levels of bit arrays with ranks."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        done = 0
        while len(h1):
            if len(self.levels) >= MAX_LEVELS:
                raise ValueError("keys are not distinct")
            m = 64 * math.ceil(GAMMA * len(h1) / 64)
            at = (_mixed(h1, h2, len(self.levels)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            ranks = done + np.concatenate([[0], np.cumsum(alone.reshape(-1, 64).sum(axis=1))[:-1]]).astype(np.int64)
            self.levels.append((m, np.packbits(alone, bitorder="little"), ranks))
            done += int(alone.sum())
            left = ~alone[at]
            h1, h2 = h1[left], h2[left]
        self.size = done

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for some that were not given (others get any slot)."""
        out, rest = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, (m, bits, ranks) in enumerate(self.levels):
            at = (_mixed(h1[rest], h2[rest], level) % np.uint64(m)).astype(np.int64)
            hit = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            where = at[hit]
            words = bits.view("<u8")[where >> 6]
            below = words & ((np.uint64(1) << (where & 63).astype(np.uint64)) - np.uint64(1))
            out[rest[hit]] = ranks[where >> 6] + np.bitwise_count(below).astype(np.int64)
            rest = rest[~hit]
        return out


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = pdf.h1.to_numpy().view(np.uint64), pdf.h2.to_numpy().view(np.uint64)
    index = PerfectHash(h1, h2)
    slot = index.slots(h1, h2)
    prints, counts, first = np.empty(len(h1), np.uint64), np.empty(len(h1), np.int64), np.empty(len(h1), np.int64)
    prints[slot], counts[slot], first[slot] = h2, pdf.n.to_numpy(), pdf["first"].to_numpy()
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "arrays": [pickle.dumps((index, prints, counts, first), protocol=5)]})


def _probe(probes: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
    if probes.empty or arrays.empty:
        return pd.DataFrame({"doc_id": pd.Series(dtype="int64"), "key": pd.Series(dtype="object")})
    index, prints, counts, first = pickle.loads(arrays["arrays"].iloc[0])
    h1, h2, doc = probes.h1.to_numpy().view(np.uint64), probes.h2.to_numpy().view(np.uint64), probes.doc_id.to_numpy()
    slot = index.slots(h1, h2)
    if (slot < 0).any() or (prints[slot] != h2).any():
        raise ValueError("a line is not in its shard's index")
    hit = (counts[slot] > 1) & (first[slot] != doc)
    pairs = np.stack([h1[hit], h2[hit]], axis=1).astype("<u8")
    return pd.DataFrame({"doc_id": doc[hit], "key": [row.tobytes() for row in pairs]})


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, shard_rows: int = 500_000) -> DataFrame:
    """(doc_id, drops array<binary>): digests of the lines each document loses."""
    spark = docs.sparkSession

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                found = {k for k in line_keys(text, min_chars) if k is not None}
                ids += [doc] * len(found)
                keys += found
            pairs = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["doc_id", "h1", "h2"])

    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    lines = written(given.mapInArrow(hashed, "doc_id bigint, h1 bigint, h2 bigint"), "lines")
    known = lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    shards = max(64, math.ceil(lines.count() / shard_rows))
    shard = F.pmod("h1", F.lit(shards)).cast("int").alias("shard")
    arrays = written(
        known.select("h1", "h2", "first", "n", shard).groupBy("shard").applyInPandas(_build, "shard int, arrays binary"), "arrays"
    )
    # a shard with very common lines gets as many copies of its arrays as level the probes; one row a shard
    load = {r["shard"]: r["count"] for r in lines.groupBy(shard).count().collect()}
    fair = max(1, sum(load.values()) // shards)
    copies = spark.createDataFrame([(s, math.ceil(n / fair)) for s, n in sorted(load.items())], "shard int, copies int")
    served = arrays.join(F.broadcast(copies), "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "arrays")
    probes = lines.select("doc_id", "h1", "h2", shard).join(F.broadcast(copies), "shard").withColumn("copy", F.pmod(F.xxhash64("doc_id"), F.col("copies")).cast("int")).drop("copies")
    hits = probes.groupBy("shard", "copy").cogroup(served.groupBy("shard", "copy")).applyInPandas(_probe, "doc_id bigint, key binary")
    return written(hits.groupBy("doc_id").agg(F.collect_set("key").alias("drops")), "drops")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, digest_only: bool = False, shard_rows: int = 500_000) -> DataFrame:
    """Drop lines that an earlier document (smaller id) has too.

    Returns per input row: row (struct of all input columns), doc_id, n_lines,
    n_dropped, kept (the text without its dropped lines; its SHA-256 in lowercase
    hex where ``digest_only``, and then row is left out). A null or empty text is one empty
    line. A row without an id is kept whole and gives no line to the index. Rows
    that share an id count as one document. Lines under ``min_chars`` code points
    always stay. An empty table gives no rows. Input columns of any name are
    carried inside ``row`` and can't clash.
    """
    drops = repeated_lines(docs, id_col, text_col, min_chars, shard_rows)
    own = [] if digest_only else [F.struct("*").alias("row")]
    given = docs.select(*own, F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    columns = [c for c in ("row", "doc_id", "text", "drops") if c in {*given.columns, "drops"}]
    # rows without an id have nothing to join, and would all meet in one task
    alone = given.where("doc_id is null").withColumn("drops", F.lit(None).cast("array<binary>"))
    joined = given.where("doc_id is not null").join(drops, "doc_id", "left").select(*columns).unionByName(alone.select(*columns))
    schema = fields_and([f for f in joined.schema.fields if f.name in ("row", "doc_id")], "n_lines bigint, n_dropped bigint, kept string")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            n_lines, n_dropped, kept = [], [], []
            for text, gone in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("drops").to_pylist()):
                lines = (text or b"").split(b"\n")
                n_lines.append(len(lines))
                if gone:
                    gone = set(gone)
                    lines = [line for line, key in zip(lines, line_keys(text, min_chars)) if key not in gone]
                n_dropped.append(n_lines[-1] - len(lines))
                left = b"\n".join(lines)
                kept.append(hashlib.sha256(left).hexdigest() if digest_only else left.decode())
            out = {f: batch.column(f) for f in schema.fieldNames() if f in ("row", "doc_id")}
            yield pa.RecordBatch.from_pydict(out | {"n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64()), "kept": pa.array(kept, pa.string())})

    return joined.mapInArrow(cut, schema)
