import collections
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from loomery.llm import jaccard, simhash
from tests.llm.conftest import SCHEMA, rows_of, words
from tests.llm.test_operators import LOWER, plain_components, plain_fingerprint


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def edited(rng, text, n):
    w = text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = words(rng, 1) + "x"
    return " ".join(w)


def expected(texts):
    sets, prints = [shingles(t) for _, t in texts], [plain_fingerprint(t, 5) for _, t in texts]
    linked = lambda i, j: bin(prints[i] ^ prints[j]).count("1") <= 2 or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) > 0
    roots = plain_components(len(texts), linked)
    least = collections.defaultdict(list)
    for (i, _), r in zip(texts, roots):
        least[r] += [i] if i is not None else []
    return sorted(((i, min(least[r], default=None)) for (i, _), r in zip(texts, roots)), key=repr)


def near_texts():
    rng = random.Random(6)
    base = [words(rng, rng.randint(40, 150)) for _ in range(30)]
    texts = list(enumerate(base))
    texts += [(100 + 10 * i + k, edited(rng, base[i], k)) for i in range(20) for k in range(1, 6)]
    passage = words(rng, 40)
    texts += [(1000 + i, f"{passage} {words(rng, rng.choice((5, 8, 30)))}") for i in range(60)]
    return texts


@pytest.mark.parametrize("crowd", [32, 2])
def test_near_copies_are_those_of_all_pairs(spark, texts, crowd):
    given = texts + near_texts()
    table = spark.createDataFrame(rows_of(given), SCHEMA).repartition(3)
    found = jaccard.near_copies(table, crowd=crowd).collect()
    assert sorted(map(tuple, found), key=repr) == expected(given)


def test_stage_drops_near_copies_beyond_two_bits(spark):
    given = near_texts()
    table = spark.createDataFrame(rows_of(given), SCHEMA).select(*corpus_pipeline.COLUMNS)
    kept = {r["doc_id"] for r in corpus_pipeline.keep_one_of_near_copies(spark, table, "").collect()}
    assert kept == {c for _, c in expected(given)}
    by_bits = {r["component_id"] for r in simhash.near_duplicates(table, words_per_shingle=5).collect()}
    assert len(kept) < len(by_bits)


def test_sketches_reject_no_near_pair():
    rng = np.random.default_rng(3)
    for n in (1, 5, 63, 64, 65, 900, 1024, 1150, 70_000):
        for alone in (0, n // 10, n // 5, n):
            both = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
            a, b = (np.unique(np.append(both, rng.integers(0, 1 << 63, k, np.uint64))) for k in (alone, n // 20))
            x, y = jaccard.sketch_of(a), jaccard.sketch_of(b)
            assert jaccard.apart_at_least(x, y) == jaccard.apart_at_least(y, x) <= len(np.setxor1d(a, b))
            assert jaccard.may_be_near(len(a), len(b), x, y) or not jaccard.near(a, b)


def test_sets_of_pairs_that_only_share_a_passage_are_not_moved(spark, monkeypatch):
    rng, moved = random.Random(8), []
    passage = words(rng, 60)
    given = [(i, f"{passage} {words(rng, 100)}") for i in range(80)] + [(100 + i, f"{passage} {words(rng, 5)}") for i in range(3)]
    table = spark.createDataFrame(rows_of(given), SCHEMA)
    written = jaccard.written

    def spy(df, label, *more):
        out = written(df, label, *more)
        if label == "sets":
            moved.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "written", spy)
    monkeypatch.setattr(jaccard, "SAMPLE", 0)  # no order keeps the passage out of the prefixes
    found = jaccard.near_copies(table, crowd=4).collect()
    assert sorted(map(tuple, found), key=repr) == expected(given)
    assert max(moved) < 20
