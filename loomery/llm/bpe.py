"""Byte-level BPE with the tokenizers library over Arrow batches.

The model is rebuilt from a rank file: every rank's bytes become characters by
the usual byte-to-character table, and each token's merge is the last one that
joining its bytes by lower ranks arrives at. Text is cut by the pattern first;
pieces recur, so a worker remembers the ids of pieces it has met (a cache
bounded in bytes; long pieces are not kept) and asks the library's model for the
others. Decoding reverses the byte-to-character table over the tokens' spellings.

Token offsets: a token's characters are its bytes, so the lengths of the spellings
of the ids give byte offsets; the count of UTF-8 lead bytes up to there gives characters.
A token that holds part of a character covers the whole of it, so neighbours may
overlap; such tokens are counted as split.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import models

from loomery.llm.store import fields_and

#: Bytes of pieces and ids that a worker keeps, and characters of the longest piece it keeps.
CACHE_BYTES, LONGEST = 32_000_000, 256
#: What a kept piece costs beside its text and its ids.
OVERHEAD = 200


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """Character that stands for each byte: itself where printable, else one from 256 up."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that merges of ranks below the token's own leave of it."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank >= ranks[token]:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class ByteBpe:
    """Encoder and decoder of one rank file; one a worker and file."""

    def __init__(self, path: str, pattern: str) -> None:
        ranks = read_ranks(path)
        chars = byte_characters()
        spelt = {token: "".join(chars[b] for b in token) for token in ranks}
        merges = [(spelt[h[0]], spelt[h[1]]) for token in sorted(ranks, key=ranks.__getitem__) if len(token) > 1 and (h := _halves(token, ranks))]
        self.model = models.BPE(vocab={spelt[t]: r for t, r in ranks.items()}, merges=merges)
        self.table = str.maketrans({chr(b): c for b, c in enumerate(chars)})
        self.reverse = str.maketrans({c: chr(b) for b, c in enumerate(chars)})
        self.spelling = [""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.spelling[rank] = spelt[token]
        self.lengths = np.array(list(map(len, self.spelling)), np.int64)
        self.pattern = regex.compile(pattern)
        #: ids of a piece as bytes; all else follows from them, so nothing else is kept
        self.known: dict[str, bytes] = {}
        #: what was known before; pieces met again come back from there
        self.older: dict[str, bytes] = {}
        self.kept = 0

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of the long pieces; short ones are known from here on."""
        if self.kept > CACHE_BYTES // 2:
            self.known, self.older, self.kept = {}, self.known, 0
        known, older, tokens_of, table, found = self.known, self.older, self.model.tokenize, self.table, {}
        for p in dict.fromkeys(pieces):
            if p in known:
                continue
            ids = older.get(p)
            if ids is None:
                # bytes as characters: the library then sees the piece as one word
                ids = array("I", [t.id for t in tokens_of(p.encode().decode("latin-1").translate(table))]).tobytes()
            if len(p) <= LONGEST:
                known[p] = ids
                self.kept += len(p) + len(ids) + OVERHEAD
            else:
                found[p] = ids
        return found

    def _each(self, pieces: list[str]) -> list[bytes]:
        known = self.known
        try:
            return [known[p] for p in pieces]
        except KeyError:
            found = self._new(pieces)
            known = self.known
            return [known[p] if len(p) <= LONGEST else found[p] for p in pieces]

    def ends(self, ids: bytes) -> np.ndarray:
        """Byte offset of each token's end."""
        return np.cumsum(self.lengths[np.frombuffer(ids, "<u4")])

    def split(self, ids: bytes, raw: bytes) -> int:
        """How many tokens hold part of a character of ``raw``, the bytes of the ids."""
        if raw.isascii():
            return 0
        within = np.frombuffer(raw, np.uint8)[self.ends(ids)[:-1]] & 0xC0 == 0x80
        return int((np.append(within, False) | np.append(False, within)).sum())

    def results(self, text: str) -> list[tuple[bytes, bytes, int]]:
        """Ids, byte offsets of the ends, and number of split tokens of each piece."""
        pieces = self.pattern.findall(text)
        return [(ids, self.ends(ids).astype("<u4").tobytes(), self.split(ids, p.encode())) for p, ids in zip(pieces, self._each(pieces))]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(self._each(self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the ids; characters that were split between tokens come together again."""
        spelling = self.spelling
        return "".join([spelling[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).translate(self.reverse).encode("latin-1")

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and end (exclusive) of each token in characters of the text."""
        ends = self.ends(self.encode(text))
        if not len(ends):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        lead = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
        return lead[starts] - 1, lead[ends - 1]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False) -> DataFrame:
    """row (struct of all input columns), doc_id, ids array<int>; with ``offsets`` also starts, ends (array<int>, characters).

    A null text counts as empty and has no ids. Every row gives one row, repeated
    rows too; an empty table gives none. Input columns of any name stay in ``row``.
    """
    given = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    more = ["starts", "ends"] if offsets else []
    schema = fields_and([f for f in given.schema.fields if f.name != "text"], ", ".join(f"{n} array<int>" for n in ("ids", *more)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("ids", *more)}
            for text in batch.column(2).to_pylist():
                ids = bpe.encode(text or "")
                out["ids"].append(np.frombuffer(ids, "<i4"))
                if offsets:
                    for name, values in zip(more, bpe.offsets(text or "")):
                        out[name].append(values.astype(np.int32))
            arrays = [pa.array(v, pa.list_(pa.int32())) for v in out.values()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], schema.fieldNames())

    return given.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """All input columns but ``decoded`` (binary), which is replaced: the bytes of each row's ids, null for null ids."""
    kept = encoded.drop("decoded")
    at = kept.columns.index(ids_col)
    schema = fields_and(kept.schema.fields, "decoded binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            values = [None if ids is None else bpe.decode(np.array(ids, "<u4").tobytes()) for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.binary())], schema.fieldNames())

    return kept.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_split: encodes each text and decodes the ids again.

    n_split counts tokens that hold part of a character, by their offsets. With ``ids`` also ids (array<int>);
    else digests only are kept.

    Nulls, empty texts, repeats and empty tables as in ``encode``.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = fields_and([given.schema["doc_id"]], "n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_split bigint" + ", ids array<int>" * ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            for at in range(0, len(batch), 512):  # few texts and results at a time
                part = batch.slice(at, 512)
                made, back, split = [], [], []
                for text in part.column(1):
                    ids_of = bpe.encode(text.as_py() or "")
                    decoded = bpe.decode(ids_of)
                    made.append(ids_of)
                    back.append(hashlib.sha256(decoded).hexdigest())
                    split.append(bpe.split(ids_of, decoded))
                digests = [hashlib.sha256(i).hexdigest() for i in made]
                columns = [pa.array([len(i) // 4 for i in made], pa.int64()), *(pa.array(d, pa.string()) for d in (digests, back)), pa.array(split, pa.int64())]
                if ids:
                    columns.append(pa.array([np.frombuffer(i, "<i4") for i in made], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema.fieldNames())

    return given.mapInArrow(run, schema)
