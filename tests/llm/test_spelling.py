import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from loomery.llm import spelling
from tests.llm.conftest import SCHEMA, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(texts, damage, least=5, count=3):
    held = collections.Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if damage and h % damage == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            held[word] += len(word) >= least
    return {w: n for w, n in held.items() if n >= count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n):
    form, near = {}, {}
    for w in n:
        near[w] = [v for v in n if one_edit(w, v)]
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def found(counted):
    return sorted(tuple(r) for r in spelling.variants(counted).select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("damage", [0, 3])
def test_words(docs, texts, no_docs, damage):
    texts = [*texts, *[(i, "Ünïcödé fÜnf× ÷abĀcd straßE " + "É" * 7) for i in (1, 2, 3)]]
    docs = docs.unionByName(docs.sparkSession.createDataFrame(rows_of(texts[-3:]), SCHEMA))
    got = {r["word"]: r["n"] for r in spelling.counted_words(docs, damage=damage).collect()}
    assert got == plain_words(texts, damage)
    assert spelling.variants(spelling.counted_words(no_docs)).count() == 0


def test_pieces_cut_no_run(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 5)
    text = " ".join("ab" * i + "é" * (i % 3) for i in range(40)).encode()
    assert [w for p in spelling.pieces(text) for w in spelling.RUNS.findall(p)] == spelling.RUNS.findall(text)
    assert list(spelling.pieces(b"")) == [] and b"".join(spelling.pieces(b"\xc3\xa9" * 50)) == b"\xc3\xa9" * 50


def test_variants_against_all_pairs(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(350)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "abababa"}
    # one long chain of words that are prefixes of each other, and long words at one edit
    words |= {"x" * 400, "x" * 401, "x" * 200 + "y" + "x" * 199, "x" * 402, "y" + "x" * 399, "x" * 399 + "y"}
    n = {w: rng.choice((3, 3, 4, 6, 9, 12, 24, 48, 96)) for w in words}
    counted = spark.createDataFrame([(w, k, "extra") for w, k in n.items()] + [(None, 5, None)], "word string, n bigint, s string").repartition(3)
    assert found(counted) == plain_variants(n)


def test_long_words_take_few_levels(spark):
    rng = random.Random(1)
    word = "".join(rng.choice("abcdefgh") for _ in range(50_000))
    n = {word: 9, word[:25_000] + "z" + word[25_000:]: 3, word[1:]: 4, word[:-1]: 4}
    got = {r[0]: (r[4], r[2]) for r in found(spark.createDataFrame(list(n.items()), "word string, n bigint"))}
    assert all(got[w][1] == word for w in n) and got[word][0] == 3


def test_merged_nodes_add_no_neighbours(spark, monkeypatch):
    """Nodes of equal hash only add candidates."""
    words = ["stone", "stony", "stones", "atone", "tones", "stane", "plank", "plant"]
    df = spark.createDataFrame(list(enumerate(words)), "wid bigint, word string").withColumn("word", F.col("word"))
    got = {(words[r[0]], words[r[1]]) for r in spelling.neighbours(df).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}
