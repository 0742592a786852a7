import collections
import hashlib
import random

import numpy as np
import pytest

from loomery.llm import suffix_dedup
from tests.llm.conftest import SCHEMA, rows_of


def plain(texts, length):
    data = [(i, (t or "").encode()) for i, t in texts]
    held = collections.Counter(d[j : j + length] for _, d in data for j in range(len(d) - length + 1))
    out = []
    for i, d in data:
        gone = np.zeros(len(d), bool)
        for j in range(len(d) - length + 1):
            if held[d[j : j + length]] > 1:
                gone[j : j + length] = True
        runs = suffix_dedup.runs_of(gone)
        out.append((i, len(d), int(gone.sum()), len(runs), bytes(np.frombuffer(d, np.uint8)[~gone])))
    return sorted(out, key=repr)


def found(docs, **how):
    rows = suffix_dedup.drop_repeats(docs, **how).selectExpr("doc_id", "n_bytes", "n_removed", "size(spans)", "kept").collect()
    return sorted(((*r[:4], bytes(r[4])) for r in rows), key=repr)


@pytest.fixture(scope="module")
def more(texts):
    rng = random.Random(8)
    words = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    passage = words(90)
    pairs = [(1000 + i, words(rng.randint(0, 60)) + passage + words(rng.randint(0, 60))) for i in range(40)]
    pairs += [(1100, "ab" * 100), (1101, "ba" * 30), (1102, "x" * 41), (1103, "x" * 40), (1104, "y" * 300), (1107, "abcdefghijklm" * 30), (1108, "xx" + "defghijklmabc" * 9 + "xx"), (1109, "klmabcdefghij" * 4), (1110, "uvwxyzUVWXYZ-" * 4), (1105, passage[:39]), (1106, passage[3:45] * 2)]
    return texts[:60] + texts[-14:] + pairs


@pytest.mark.parametrize("length, grams, shard_bytes", [(40, (8, 38), 1 << 20), (40, (8, 38), 700), (40, (40,), 300), (400, (64, 390), 4000)])
def test_repeats(spark, more, length, grams, shard_bytes):
    docs = spark.createDataFrame(rows_of(more), SCHEMA).repartition(3)
    assert found(docs, length=length, grams=grams, shard_bytes=shard_bytes) == plain(more, length)


def test_defined_results(spark, docs, texts, no_docs):
    assert suffix_dedup.drop_repeats(no_docs).count() == 0
    kept = suffix_dedup.drop_repeats(docs)
    assert kept.select("row.*").columns == docs.columns and kept.count() == len(texts)
    digests = sorted(((r.doc_id, r.kept) for r in suffix_dedup.drop_repeats(docs, digest_only=True).collect()), key=repr)
    assert digests == sorted(((r[0], hashlib.sha256(r[4]).hexdigest()) for r in plain(texts, 400)), key=repr)


@pytest.mark.parametrize("seed", range(30))
def test_boundaries_are_shared_prefixes(seed):
    rng = random.Random(seed)
    n, length = rng.randint(1, 300), rng.choice((1, 2, 5, 20))
    text = [rng.choice(range(1, rng.choice((2, 3, 6)) + 1)) for _ in range(n)]
    if seed % 3 == 0:
        text = (text[: n // 3] * 3)[:n] or [1]
    code = np.array([*text, 0], np.uint16)
    order = suffix_dedup.suffix_order(code, length)
    suffix = [tuple(code[i : i + length]) for i in order]
    assert suffix == sorted(suffix)
    assert suffix_dedup.boundaries(code, order, length).tolist() == [True] + [a != b for a, b in zip(suffix, suffix[1:])]


@pytest.mark.parametrize("gram", [1, 2, 7, 16, 63, 64, 100])
def test_anchors(gram, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 333)
    monkeypatch.setattr(suffix_dedup, "MOST_STARTS", 50)
    rng = random.Random(gram)
    data = np.frombuffer(bytes(rng.choice(b"abc") for _ in range(900)) + b"z" * 700, np.uint8)
    hashes = {}
    for i, h in enumerate(suffix_dedup.gram_hashes(data, gram)):
        assert hashes.setdefault(bytes(data[i : i + gram]), h) == h
    assert len(set(hashes.values())) == len(hashes)
    for texts in ([data.tobytes()], [b"a" * 50, data.tobytes()[:150], b"", data.tobytes(), data.tobytes()[5:120], b"b" * 99]):
        found = [np.concatenate(x) for x in zip(*suffix_dedup.segments(texts, 100, gram))]
        for i, text in enumerate(texts):
            anchor, first, size, again, period = (x[found[0] == i] for x in found[1:])
            assert size.sum() == max(0, len(text) - 99) and (size <= 50).all()
            if len(text) < 100:
                continue
            assert first[0] == 0 and (first[1:] == (first + size)[:-1]).all()
            assert len(text) < 900 or 1 in period[~again]
            for a, f, n in zip(anchor, first, size):
                assert all(min(hashes[text[j : j + gram]] for j in range(i, i + 101 - gram)) == a for i in (f, f + n - 1))


def test_stretches():
    body = np.frombuffer(b"qwer" + b"abcde" * 30 + b"ab" + b"tzu", np.uint8)
    places = np.flatnonzero(np.lib.stride_tricks.sliding_window_view(body, 2) @ np.array([1, 300]) == ord("a") + 300 * ord("b"))
    assert suffix_dedup.stretch(body, places, 20) == (4, 4 + 152 - 19, 5)
    assert suffix_dedup.stretch(body[:40], places[:6], 33) is None and suffix_dedup.stretch(body[:9], places[:1], 5) is None
