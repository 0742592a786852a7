"""Token counts with overlap resynchronisation for huge documents.

A text of over ``chunk`` + ``overlap`` characters is encoded chunk by chunk, with
offsets in the document. Neighbouring chunks share ``overlap`` characters: one
encoding of them has seen the text before, the other the text after. They are
spliced at a boundary that is proven stable: both encodings start a word there,
both give the same tokens at the same places for the word before it and for the
``PROOF`` words after it, and these words are complete (the last two words of a
chunk are cut by its end and prove nothing). A tokenizer that cuts words from left
to right then goes on from there as it would in the whole text. The count is the
sum of the tokens between the boundaries. Where an overlap holds no such boundary,
it is doubled, up to the rest of the document.

Shorter texts are encoded whole. Words recur in these, so where a file is proven to
drop white space and to cut words there (``drops_blanks``), a worker keeps the counts
of the words it has met, bounded in number, and the library gets only new ones.
"""

from __future__ import annotations

import json
import os
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from loomery.llm.store import fields_and

PROOF, CUT_WORDS = 3, 2
#: Texts that the library gets in one call; words that a worker keeps.
GROUP, KEPT_WORDS = 64, 600_000
#: White space as normalisers and patterns see it (Unicode White_Space).
BLANKS = regex.compile(r"\p{White_Space}+")
#: Normalisers that leave blanks and what stands between two of them apart.
APART = {"NFC", "NFD", "Lowercase"}


def drops_blanks(file: dict) -> bool:
    """Whether a tokenizer file is proven to encode a text as its words between blanks.

    Its normalisers change no character by others beyond a blank; its first
    pre-tokenizer keeps only what a pattern matches; that pattern matches no blank: no
    blank, dot or class that holds one is left in it when the negated classes that rule
    blanks out are taken away. No added string holds a blank or takes one in beside it.
    """
    steps = file.get("normalizer") or {}
    for step in steps.get("normalizers", [steps] if steps else []):
        whole_blanks = step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " "
        if step["type"] not in APART and not whole_blanks:
            return False
    cutter = file.get("pre_tokenizer") or {}
    first = cutter.get("pretokenizers", [cutter])[0]
    if first.get("type") != "Split" or first.get("behavior") != "Removed" or not first.get("invert"):
        return False
    rest = regex.sub(r"\[\^[^\[\]]*\\s[^\[\]]*\]", "", first["pattern"].get("Regex", " "))
    if BLANKS.search(rest) or regex.search(r"\.|\[\^|\\(?![pP]\{[LN]\})|\\P", rest):
        return False
    return not any(BLANKS.search(t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in file.get("added_tokens", []))


class Encoded:
    """Tokens of the chunk [at, end): ids, places in it, and their words."""

    def __init__(self, model: Tokenizer, text: str, at: int, end: int) -> None:
        e = model.encode(text[at:end], add_special_tokens=False)
        self.at, self.end, self.ids, self.offsets, self.words = at, end, e.ids, e.offsets, e.word_ids

    def heads(self, lo: int, hi: int) -> list[int]:
        """Tokens that start a word at characters lo to hi of the document."""
        first, last = (bisect_left(self.offsets, c - self.at, key=lambda o: o[0]) for c in (lo, hi))
        words = self.words
        return [i for i in range(first, last) if i == 0 or words[i] is None or words[i] != words[i - 1]]

    def place(self, i: int) -> int:
        return self.offsets[i][0] + self.at

    def same(self, a: int, b: int, other: Encoded, at: int) -> bool:
        """Whether tokens a to b are those of ``other`` from ``at`` on, at the same places of the document."""
        shift = self.at - other.at
        return at >= 0 and self.ids[a:b] == other.ids[at : at + b - a] and [(x + shift, y + shift) for x, y in self.offsets[a:b]] == other.offsets[at : at + b - a]


def boundary(left: Encoded, right: Encoded, cut: int) -> tuple[int, int] | None:
    """First stable boundary of two encodings from ``cut`` on, as a token of each."""
    heads = left.heads(cut, left.end)
    of_place = {right.place(j): j for j in reversed(right.heads(cut, left.end))}
    for k in range(1, len(heads) - CUT_WORDS - PROOF + 1):
        i, before, after = heads[k], heads[k - 1], heads[k + PROOF]
        j = of_place.get(left.place(i))
        if j is not None and left.same(before, after, right, j - (i - before)):
            return i, j
    return None


class TokenCounter:
    """Counts tokens by one tokenizer file; one a worker and file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        with open(path, encoding="utf-8") as file:
            self.by_word = drops_blanks(json.load(file))
        self.known: dict[str, int] = {}

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def by_words(self, text: str) -> int:
        """Tokens of a text as the sum over its words."""
        words, known = BLANKS.split(text), self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            if len(known) + len(new) > KEPT_WORDS:
                known.clear()
                new = list(dict.fromkeys(words))
            known.update(zip(new, self.whole(new)))
        return sum([known[w] for w in words])

    def spliced(self, text: str, chunk: int, overlap: int) -> int:
        """Tokens of a text by chunks that start every ``chunk`` characters."""
        size, at, width = len(text), 0, overlap
        # tokens of ``left`` from ``start`` on are still to be counted
        total, start, left = 0, 0, Encoded(self.model, text, 0, min(chunk + overlap, size))
        while left.end < size:
            cut = at + chunk
            right = Encoded(self.model, text, cut, min(cut + max(chunk, width) + overlap, size))
            found = boundary(left, right, cut)
            if found is None:
                width *= 2
                left = Encoded(self.model, text, at, min(cut + width, size))
                continue
            total += found[0] - start
            at, start, left, width = cut, found[1], right, overlap
        return total + len(left.ids) - start

    def counts(self, texts: list[str], chunk: int, overlap: int) -> list[int]:
        out = [0] * len(texts)
        short = [i for i, t in enumerate(texts) if len(t) <= chunk + overlap]
        for at in range(0, len(short), GROUP):
            group = [texts[i] for i in short[at : at + GROUP]]
            for i, n in zip(short[at:], map(self.by_words, group) if self.by_word else self.whole(group)):
                out[i] = n
        for i in {*range(len(texts))}.difference(short):
            out[i] = self.spliced(texts[i], chunk, overlap)
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", chunk: int = 1 << 14, overlap: int = 256
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    n_tokens is what encoding the whole text gives, without added special tokens;
    special strings inside a text are handled as the file's default. A null text
    counts as empty (0, 0, false). Repeated rows give repeated rows, an empty
    table none; further columns are ignored.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = fields_and([given.schema["doc_id"]], "n_bytes bigint, n_tokens bigint, over_limit boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path)
        for batch in batches:
            raw = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            counts = tokens.counts([t.decode() for t in raw], chunk, overlap)
            columns = [pa.array([len(t) for t in raw], pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.fieldNames())

    return given.mapInArrow(run, schema)
