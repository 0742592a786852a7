import collections
import hashlib
import itertools
import json
import math
import random
import re
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomery.llm import bpe, components, embed_dedup, licenses, line_dedup, mixing, pii, simhash, token_counts, topk_search, toxicity
from tests.llm.conftest import SCHEMA, rows_of, words

RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# ---- line dedup ---------------------------------------------------------------------------


def plain_lines(texts, least=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = collections.defaultdict(set)
    for i, t in texts:
        if i is not None:
            for line in (t or "").split("\n"):
                holders[key(line)].add(i)
    out = []
    for i, t in texts:
        lines = (t or "").split("\n")
        gone = lambda line: len(key(line)) >= least and len(holders[key(line)]) > 1 and min(holders[key(line)]) != i  # noqa: E731, B023
        left = lines if i is None else [x for x in lines if not gone(x)]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def test_lines(docs, texts, no_docs):
    assert got(line_dedup.dedup_lines(docs), "doc_id", "n_lines", "n_dropped", "kept") == plain_lines(texts)
    digests = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in plain_lines(texts)]
    assert got(line_dedup.dedup_lines(docs, digest_only=True), "doc_id", "n_lines", "n_dropped", "kept") == sorted(digests, key=repr)
    assert line_dedup.dedup_lines(no_docs).count() == 0
    assert line_dedup.dedup_lines(docs).select("row.*").columns == docs.columns


def test_line_shards_of_any_size(docs, texts):
    assert got(line_dedup.dedup_lines(docs, shard_rows=2), "doc_id", "n_lines", "n_dropped", "kept") == plain_lines(texts)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    h1, h2 = rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(0, 2**63, n).astype(np.uint64)
    if n > 2:
        h1[1] = h1[0]  # the second half tells these apart
    index = line_dedup.PerfectHash(h1, h2)
    assert sorted(index.slots(h1, h2).tolist()) == list(range(n))


# ---- SimHash ---------------------------------------------------------------------------------


def plain_fingerprint(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[j : j + size]) for j in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] * bool(w)
    counts = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_components(n, linked):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_simhash(docs, texts, no_docs):
    prints = [plain_fingerprint(t) for _, t in texts]
    roots = plain_components(len(texts), lambda i, j: bin(prints[i] ^ prints[j]).count("1") <= 2)
    least = collections.defaultdict(list)
    for (i, _), r in zip(texts, roots):
        least[r] += [i] if i is not None else []
    expected = sorted(((i, p if p < 2**63 else p - 2**64, min(least[r], default=None)) for (i, _), p, r in zip(texts, prints, roots)), key=repr)
    assert got(simhash.near_duplicates(docs), "doc_id", "fp", "component_id") == expected
    assert simhash.near_duplicates(no_docs).count() == 0


def test_simhash_links_near_and_crowded(spark):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(30)]
    prints = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for c in centres for _ in range(12)})
    expected = plain_components(len(prints), lambda i, j: bin(prints[i] ^ prints[j]).count("1") <= 2)
    table = spark.createDataFrame([(p if p < 2**63 else p - 2**64,) for p in prints], "fp bigint")
    signed = [p if p < 2**63 else p - 2**64 for p in prints]
    groups = collections.defaultdict(set)
    for p, r in zip(signed, expected):
        groups[r].add(p)
    want = sorted(sorted(g) for g in groups.values() if len(g) > 1)
    for crowd in (256, 1, 0):
        found = collections.defaultdict(set)
        for r in components.components(simhash.links(table, crowd), "a", "b").collect():
            found[r["root"]].add(r["node"])
        assert sorted(sorted(g) for g in found.values()) == want


def test_every_pair_within_one_bit_shares_an_anchor():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**31, 300)
    y = x ^ np.concatenate([[0], 1 << rng.integers(0, 31, 299)])
    rx, ax, hx = simhash.anchors_of(x)
    ry, ay, _ = simhash.anchors_of(y)
    near = collections.defaultdict(set)
    for r, a in zip(ry, ay):
        near[int(r)].add(int(a))
    assert all(int(a) in near[int(r)] for r, a, h in zip(rx, ax, hx) if h)


# ---- BPE ------------------------------------------------------------------------------------

ODD = ["", "a  b  c 　 d\n\n\n e   ", "𝒳😀é́naïve '‘s DON'T don't", "\x00\x1c\x85 x\x1f y", "x" * 3000, "日本語テキスト１２３ ½ ²", "<|endoftext|> hi", "​﻿ a"]


def test_bpe_is_tiktoken(docs, texts, no_docs):
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    codec = bpe.codec(RANKS, public_tokenizers.PATTERN)
    for t in ODD:
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(t)
        assert codec.decode(ids).decode() == t
        starts, ends = codec.offsets(t)
        raw = [codec.decode(i.tobytes()) for i in np.frombuffer(ids, "<u4")]
        assert all(piece.decode(errors="ignore") in t[a:b] for piece, a, b in zip(raw, starts, ends))
    expected = []
    for i, t in texts:
        ids = np.array(plain.encode_ordinary(t or ""), "<u4").tobytes()
        expected.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got(bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    kept = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN, ids=True)
    assert all(hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest() == r["ids_sha256"] for r in kept.collect())
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, offsets=True)
    back = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    assert sorted(r[0] or "" for r in back.select(F.col("decoded").cast("string")).collect()) == sorted(t or "" for _, t in texts)
    assert bpe.round_trip(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_split_characters_cover_the_whole_character():
    codec = bpe.codec(RANKS, public_tokenizers.PATTERN)
    starts, ends = codec.offsets("é𝒳")
    assert set(zip(starts.tolist(), ends.tolist())) <= {(0, 1), (1, 2)} and ends[-1] == 2
    for t in [*ODD, "é𝒳 日本語 naïve"]:
        raw = [codec.decode(i.tobytes()) for i in np.frombuffer(codec.encode(t), "<u4")]
        broken = sum(piece.decode(errors="replace").encode() != piece for piece in raw)
        assert sum(r[2] for r in codec.results(t)) == broken


def test_long_pieces_are_not_kept_and_the_cache_is_bounded(monkeypatch):
    codec = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    whole = codec.encode("ab " * 50 + "y" * 5000)
    assert "y" * 5000 not in codec.known and " ab" in codec.known
    monkeypatch.setattr(bpe, "CACHE_BYTES", 1000)
    for i in range(50):
        codec.encode(f"w{i}x{i * 7}")
    assert codec.kept < 3000 and codec.encode("ab " * 50 + "y" * 5000) == whole


def test_pieces_met_again_are_not_asked_for_again(monkeypatch):
    codec, asked = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN), []
    model = codec.model

    class Counted:
        def tokenize(self, word):
            asked.append(word)
            return model.tokenize(word)

    codec.model = Counted()
    monkeypatch.setattr(bpe, "CACHE_BYTES", 20_000)
    for i in range(200):
        codec.encode(f"q ab {'wxyz' * (i % 7)}{i}")
    assert asked.count("Ġab") == 1 and len(asked) > 200
    assert codec.kept + sum(map(len, codec.older)) < 40_000


def test_a_kept_piece_costs_little_memory():
    codec = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    before = codec.kept
    tracemalloc.start()
    for i in range(400):
        codec.encode("".join(f" w{chr(97 + i % 26)}{chr(97 + k % 26)}{chr(97 + k // 26)}{'xyz'[i % 3]}q{chr(97 + i // 26)}" for k in range(100)))
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(codec.known) > 20_000 and held < 180 * len(codec.known) and held < codec.kept - before


# ---- token counts -----------------------------------------------------------------------------


def test_token_counts(docs, texts, no_docs):
    plain = Tokenizer.from_file(WORDS)
    size = lambda t: len(plain.encode(t or "", add_special_tokens=False))
    expected = sorted(((i, len((t or "").encode()), n := size(t), n > 100) for i, t in texts), key=repr)
    for chunk, overlap in ((1 << 16, 256), (700, 40)):
        assert got(token_counts.count_tokens(docs, WORDS, 100, chunk=chunk, overlap=overlap), "doc_id", "n_bytes", "n_tokens", "over_limit") == expected
    assert token_counts.count_tokens(no_docs, WORDS).count() == 0


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_spliced_encodings(file):
    """Boundaries of any chunks give the count of the whole text, for words that keep their blanks and for words that drop them."""
    counter = token_counts.TokenCounter(public_tokenizers.path(file))
    rng = random.Random(3)
    mixed = "".join(rng.choice(["a", "Word ", " don't", "é", "e\u0301", "\u0301", "  ", "\n\n ", "日本", "12", "...", "<|endoftext|>", "<|endof", "😀", "x" * 40, "\x85", "İ", "ΑΣ "]) for _ in range(3000))
    for t in [*ODD, "<|startoftext|>hello <|endoftext|><|startof text|>" * 9, "ΑΣ ΑΣ. İstanbul ẞ " * 9, "a\x85b\x1cc", "y" * 500 + " end " * 50, " " * 3000 + "a b c d e f g h", mixed]:
        whole = counter.whole([t])[0]
        for chunk, overlap in ((60, 8), (200, 40), (1000, 256), (1 << 16, 256)):
            assert counter.spliced(t, chunk, overlap) == whole
            assert counter.counts([t, "", t], chunk, overlap) == [whole, 0, whole]


def test_only_files_that_are_proven_to_drop_blanks_go_by_words():
    files = {name: json.load(open(public_tokenizers.path(name), encoding="utf-8")) for name in ("word_bpe_49k.json", "byte_bpe_50k.json")}
    assert [token_counts.drops_blanks(f) for f in files.values()] == [True, False]
    good = files["word_bpe_49k.json"]
    split = good["pre_tokenizer"]["pretokenizers"][0]
    for pattern in (r"\S+", r".+", r"[\p{L} ]+", r"\p{L}+|\s", r"[^\p{L}]+", r"\w+\W"):
        changed = good | {"pre_tokenizer": {"pretokenizers": [split | {"pattern": {"Regex": pattern}}]}}
        assert not token_counts.drops_blanks(changed)
    assert not token_counts.drops_blanks(good | {"normalizer": {"type": "Strip"}})
    assert not token_counts.drops_blanks(good | {"added_tokens": [good["added_tokens"][0] | {"content": "a b"}]})
    assert not token_counts.drops_blanks(good | {"pre_tokenizer": None})


def test_overlaps_that_do_not_agree_are_widened():
    counter = token_counts.TokenCounter(WORDS)
    text = "one two three " + "z" * 400 + " four five six seven eight " * 30
    left, right = (token_counts.Encoded(counter.model, text, a, b) for a, b in ((0, 120), (100, 300)))
    assert token_counts.boundary(left, right, 100) is None
    assert counter.spliced(text, 100, 20) == counter.whole([text])[0]


# ---- search ------------------------------------------------------------------------------------


def plain_search(texts, k):
    docs = [(i, collections.Counter(re.findall(r"[^\W_]+", (t or "").lower()))) for i, t in texts if i is not None]
    n, sizes = len(docs), [sum(c.values()) for _, c in docs]
    mean, df = sum(sizes) / n, collections.Counter(t for _, c in docs for t in c)
    asks = {}
    for i, t in texts:
        if i is not None and i % 50 == 0 and (i not in asks or (t is not None and (asks[i] is None or t < asks[i]))):
            asks[i] = t
    out = []
    for q, text in asks.items():
        scored = []
        for (i, c), size in zip(docs, sizes):
            s = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * size / mean)) for t in set(re.findall(r"[^\W_]+", (text or "").lower())) if t in c)
            if s > 0:
                scored.append((-round(s, 6), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def test_frequent_lists_bound_a_block_by_their_sums():
    builder = topk_search._Builder()
    for i in range(800):
        builder.add(i, "aa bb" if i in (100, 500) else ("aa cc", "bb cc")[i % 2])
    hashes = np.sort(np.array([topk_search.term_hash(w) for w in ("aa", "bb")], np.uint64))
    searcher = topk_search.Searcher(builder.shard(), 2.0, hashes, np.ones(2))
    read, scored = [], searcher._scored
    searcher._scored = lambda pivots, *rest: (read.append(len(pivots)), scored(pivots, *rest))[1]
    ids, scores = searcher.top(np.arange(2), 2, 2.0)
    assert ids.tolist() == [100, 500] and scores.tolist() == [2.0, 2.0] and sum(read) == 2  # of 100 blocks, each of which has both words


def test_search(docs, texts, no_docs):
    asks = docs.where("doc_id % 50 = 0")
    expected = plain_search(texts, 5)
    assert got(topk_search.search(docs, asks, 5), "query_id", "rank", "doc_id", "score") == expected
    assert got(topk_search.search(docs, asks, 5, block_terms=40), "query_id", "rank", "doc_id", "score") == expected
    for some in ({"shard_docs": 3}, {"shard_docs": 9, "block_queries": 1}):  # many shards a task, leading ones and others
        assert got(topk_search.search(docs.coalesce(1), asks, 5, **some), "query_id", "rank", "doc_id", "score") == expected
    assert topk_search.search(no_docs, no_docs).count() == 0
    assert topk_search.search(docs, no_docs).count() == 0


def test_pivots_of_any_threshold_keep_the_top():
    """Shards with rare and frequent lists against full scores, with and without a floor; a good floor leaves most blocks out."""
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    builder = topk_search._Builder()
    texts = [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(300)], k=rng.randint(3, 80))) for _ in range(700)]
    for i, t in enumerate(texts):
        builder.add(1000 - i, t)
    hashes = np.unique(np.array([topk_search.term_hash(w) for w in vocabulary], np.uint64))
    idf = np.array([rng.uniform(0.1, 5.0) for _ in hashes])
    searcher = topk_search.Searcher(builder.shard(), 40.0, hashes, idf)
    read = []
    scored = searcher._scored
    searcher._scored = lambda pivots, *rest: (read.append(len(pivots)), scored(pivots, *rest))[1]
    for _ in range(60):
        ask = np.array(sorted(rng.sample(range(len(hashes)), rng.randint(1, 60))))
        full = collections.Counter()
        for i, t in enumerate(texts):
            words = t.split()
            for w, c in collections.Counter(words).items():
                at = int(np.searchsorted(hashes, np.uint64(topk_search.term_hash(w))))
                if at in ask:
                    full[1000 - i] += idf[at] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(words) / 40.0))
        best = sorted(((-round(s, 6), i) for i, s in full.items()))[:10]
        ids, scores = searcher.top(ask, 10)
        assert ids.tolist() == [i for _, i in best] and np.allclose(scores, [-s for s, _ in best], atol=2e-6)
        if len(best) == 10:
            read.clear()
            ids, scores = searcher.top(ask, 10, -best[4][0])
            assert ids[:5].tolist() == [i for _, i in best[:5]] and sum(read) <= searcher.blocks


def test_batches_give_what_single_queries_give_beyond_single_precision():
    """Scores that differ by less than single precision tells: the order is that of double precision, whatever the batch."""
    builder = topk_search._Builder()
    rng = random.Random(9)
    words = [f"w{i}" for i in range(120)]
    for i in range(600):
        builder.add(i, " ".join(words[:90] + (["x"] if i % 97 == 0 else []) + rng.choices(words[90:], k=i % 5)))
    hashes = np.unique(np.array([topk_search.term_hash(w) for w in [*words, "x"]], np.uint64))
    idf = np.where(hashes == topk_search.term_hash("x"), 1e-5, 1000.0)
    searcher = topk_search.Searcher(builder.shard(), 90.0, hashes, idf)
    asks = [np.array(sorted(rng.sample(range(len(hashes)), rng.randint(1, 110)))) for _ in range(150)] + [np.arange(len(hashes)), np.zeros(0, np.int64)]
    alone = [searcher.top(a, 7) for a in asks]
    found = {i: (ids, scores) for i, ids, scores in searcher.tops(asks, 7, np.zeros(len(asks)))}
    for i, (ids, scores) in enumerate(alone):
        exact = np.round(searcher.full[:, [r for r in searcher.row[asks[i]] if r >= 0]].sum(axis=1) + sum((np.bincount(searcher.docs[s : s + n], searcher.impact[s : s + n], 600) for s, n in zip(searcher.start[asks[i]], searcher.size[asks[i]])), np.zeros(600)), 6)
        best = [d for d in np.lexsort((np.arange(600), -exact))[:7].tolist() if exact[d] > 0]
        assert ids.tolist() == best and np.array_equal(scores, exact[best])
        assert not best and i not in found or (found[i][0].tolist(), found[i][1].tolist()) == (ids.tolist(), scores.tolist())


def test_later_rounds_give_few_hits(spark, monkeypatch):
    rng, hits = random.Random(2), []
    table = spark.createDataFrame(rows_of([(i, words(rng, 30)) for i in range(1200)]), SCHEMA).repartition(4)
    written = topk_search.written

    def spy(df, label, *more):
        out = written(df, label, *more)
        if label == "hits":
            hits.append(out.count())
        return out

    monkeypatch.setattr(topk_search, "written", spy)
    asks = table.where("doc_id % 50 = 0")
    found = topk_search.search(table, asks, 3, shard_docs=10)
    assert found.count() == 24 * 3 and len(hits) == 3
    # all shards together have 120 x 24 x 3 best ones; a later round gives those that reach the threshold alone
    assert hits[0] <= 4 * 24 * 3 and max(hits[1:]) < 24 * 3 * 12


# ---- personal data --------------------------------------------------------------------------------

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_pii(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    good = {
        "email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")), "card": lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)), "phone": lambda s: 9 <= len(digits(s)) <= 15,
    }
    return [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if good[k](m.group())] for k, p in BASE]


def pii_texts():
    rng = random.Random(8)
    bits = ["a.b@c.d.e", "x@y", "@", "..", "a@b..c", "q-@-.-", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.002.3.255", "4111 1111 1111 1111", "4111-1111  1111-1111", "4111111111111111", "+1 (234) 567-8901", "+12", "+1..........2", "é", "\n", " ", "-", "7", "", "a@b.c_d@e.f", "+4 9-1 5)1 2345678", "0" * 40, "9.9.9", "😀"]
    return [(i, "".join(rng.choice(bits) for _ in range(rng.randint(1, 12)))) for i in range(400)] + [(900, None), (901, ""), (902, "1 " * 20_000), (903, "a" * 50_000 + "@"), (904, "a@" + "b." * 20_000 + "c"), (905, "1" * 50_000), (906, "a@b.c " * 2000)]


def test_pii_base(spark, no_docs):
    texts = pii_texts()
    table = spark.createDataFrame(rows_of(texts), SCHEMA)
    expected = []
    for i, t in texts:
        found = plain_pii(t)
        expected.append((i, *map(len, found), hashlib.sha256(",".join(sum(found, [])).encode()).hexdigest()))
    out = pii.extract(table)
    assert got(out, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(expected, key=repr)
    assert pii.extract(no_docs).count() == 0


def test_pii_contexts_find_unseen_identifiers(spark):
    texts = [(i, f"some words here. Contact: user{i}@mail.example then more") for i in range(20)]
    texts += [(100 + i, f"other words. Contact: user-77-{i}-at-mail and so on, call 12345678 now") for i in range(3)]
    texts += [(200 + i, f"the value {10000000 + i} and the other") for i in range(20)]
    texts += [(300, "Contact: x"), (301, None)]
    rows = {r["doc_id"]: r for r in pii.extract(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()}
    assert all(rows[100 + i]["n_id"] == 1 and rows[100 + i]["spans"].startswith("id:22:") for i in range(3))
    assert all(rows[i]["n_email"] == 1 and rows[i]["n_id"] == 0 for i in range(20))
    assert all(rows[200 + i]["spans"] == "" for i in range(20)) and rows[300]["spans"] == ""


def test_pii_patterns_beyond_one_token(spark):
    """Credentials by shape teach contexts of several tokens on both sides; these find values of any shape. A dot in a context is one."""
    rng = random.Random(11)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    texts = [(i, f'words and words auth_key = "{key()}" go on') for i in range(8)] + [(50 + i, f'more auth_key = "pass-{i}word" after') for i in range(3)]
    texts += [(100 + i, f"my.mail: user{i}@mail.example.com is here") for i in range(9)] + [(120, "my.mail: somebody-77-at-home is here"), (121, "the my.mail: is here")]
    texts += [(200 + i, f"commit {key()} landed; commit rights matter and commit often, commit it") for i in range(9)] + [(300, f"loose {key()} alone"), (None, f'x auth_key = "{key()}" y')]
    texts += [texts[0]]
    rows = pii.extract(spark.createDataFrame(rows_of(texts), SCHEMA), confidence=0.6).collect()
    found = {(r["doc_id"], r["n_id"], r["n_spans"]) for r in rows}
    assert {(i, 1, 1) for i in [*range(8), 50, 51, 52, None, 120]} <= found
    assert {(100 + i, 0, 1) for i in range(9)} | {(121, 0, 0), (300, 0, 0)} <= found
    assert len(rows) == len(texts) and [r["spans"] for r in rows if r["doc_id"] == 51] == ["id:17:27"]


def test_pii_scores_are_those_of_the_plain_graph(spark):
    rng = random.Random(12)
    edges = {(rng.randrange(30), f"v{rng.randrange(60)}"): (rng.randint(1, 4), rng.random() < 0.2) for _ in range(300)}
    seeds = {v for (_, v), (_, s) in edges.items() if s}
    totals = {p: rng.randint(1, 40) for p in range(0, 30, 2)}
    own = collections.Counter()
    for (p, _), (n, _) in edges.items():
        own[p] += n
    score, accepted = dict.fromkeys(seeds, 1.0), {}
    for _ in range(3):
        weight, held = collections.Counter(), collections.Counter()
        for (p, v), (n, _) in edges.items():
            weight[p] += n * score.get(v, 0.0) / max(own[p], totals.get(p, 0))
            held[p] += score.get(v, 0.0) > 0
        accepted = {p: (w, held[p]) for p, w in weight.items() if held[p] >= 3 and w >= 0.3}
        score = dict.fromkeys(seeds, 1.0)
        for p, v in edges:
            if p in accepted and v not in seeds:
                score[v] = max(score.get(v, 0.0), accepted[p][0])
    graph = spark.createDataFrame([(p, v, n, v in seeds) for (p, v), (n, _) in edges.items()], "pattern bigint, value string, n bigint, seed boolean")
    out = pii.score_graph(graph, spark.createDataFrame(list(totals.items()), "pattern bigint, total bigint"), 3, 3, 0.3).collect()
    assert accepted and {r["pattern"]: r["held"] for r in out} == {p: h for p, (_, h) in accepted.items()}
    assert all(abs(r["weight"] - accepted[r["pattern"]][0]) < 1e-9 for r in out)


# ---- licences ------------------------------------------------------------------------------------


def body_of(name):
    return next(t for n, kind, t in licenses.KNOWN if (n, kind) == (name, "text"))


def test_licenses(spark, docs, texts, no_docs):
    mit = body_of("MIT")
    given = [
        (1, mit), (2, mit.upper().replace("COPYRIGHT (C) <YEAR> <COPYRIGHT HOLDERS>", "Copyright (c) 2020 Somebody Else\n(c) 2021 Another")), (3, mit.partition("\n\n")[2]), (4, mit + " and more"), (5, None), (6, ""), (7, "  \n"),
        (8, "text\nLicenced under the apache licence -- version 2.0\nmore\nLicensed under CC BY-NC 4.0."), (9, "Licensed under CC BY-NC 4.0. and more"), (9, mit), (None, "Released under the MIT License"),
        (10, "words\n" * 60_000 + "Licensed under CC BY-NC 4.0.\n" * 2000 + "x" * 300_000),
    ]
    out = got(licenses.scan(spark.createDataFrame(rows_of(given), SCHEMA)), "doc_id", "license", "notices")
    expected = [(1, "MIT", ""), (2, "MIT", ""), (3, "MIT", ""), (4, None, ""), (5, None, ""), (6, None, ""), (7, None, ""), (8, None, "Apache-2.0,CC-BY-NC-4.0"), (9, None, ""), (9, "MIT", ""), (10, None, "CC-BY-NC-4.0"), (None, None, "MIT")]
    assert out == sorted(expected, key=repr)
    assert licenses.scan(docs).count() == len(texts) and licenses.scan(no_docs).count() == 0


def test_wrapped_licenses(spark):
    isc = body_of("ISC").replace("above copyright notice", "above\ncopyright notice").replace("<year> <owner>", "2004-2020 Somebody <a@b.example>")
    mit = body_of("MIT").replace("COPYRIGHT HOLDERS BE", "\nCOPYRIGHT HOLDERS BE").replace("(c) <year>", "2019").replace('"', "“").replace("\n", "\r\n")
    signs = [body_of("Zlib").replace("Copyright (c) <year> <owner>", line) for line in ("Copyright © Somebody", "(c) 2020 Somebody", "© Somebody", "Copyright [yyyy] [name]", "  Copyright: 2020, Somebody")]
    comment = "\n".join(f" * {line}" for line in body_of("BSD-3-Clause").split("\n"))
    given = list(enumerate([isc, mit, *signs, comment]))
    out = got(licenses.scan(spark.createDataFrame(rows_of(given), SCHEMA)), "doc_id", "license")
    assert out == [(0, "ISC"), (1, "MIT"), *((i, "Zlib") for i in range(2, 7)), (7, "BSD-3-Clause")]


def test_license_lines_of_the_documents(spark):
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "// SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1", "# This file is distributed under the terms of the license": "", "Licensed under the BSD 3–Clause License": "BSD-3-Clause", "This project is licensed under the Mozilla Public Licence, version 2.0": "MPL-2.0", "no license at all": "", "License: Unlicense": "Unlicense", "mit": "",
    }
    given = list(enumerate(lines))
    assert got(licenses.scan(spark.createDataFrame(rows_of(given), SCHEMA)), "doc_id", "notices") == sorted(enumerate(lines.values()), key=repr)
    known = [(name, t) for name, kind, t in licenses.KNOWN if kind == "text"]
    given = [(i, " \n".join(t.split("\n"))) for i, (_, t) in enumerate(known)]
    assert got(licenses.scan(spark.createDataFrame(rows_of(given), SCHEMA)), "doc_id", "license") == sorted([(i, name) for i, (name, _) in enumerate(known)], key=repr)
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib"} <= {name for name, _ in known}
    own = (("Own", "text", "own words"), ("Own-notice", "notice", "Under the own license."))
    out = licenses.scan(spark.createDataFrame(rows_of([(1, "Own words"), (2, "a\nunder the own licence")]), SCHEMA), known_texts=own)
    assert got(out, "doc_id", "license", "notices") == [(1, "Own", ""), (2, None, "Own-notice")]


def test_licenses_against_a_plain_scan(spark):
    """A plain form of letters and digits, and sets of them, stand against digests."""
    plain = lambda s: re.sub("[^a-z0-9]+", " ", s.lower().replace("licence", "license")).strip()
    notices = collections.defaultdict(set)
    for name, kind, t in licenses.KNOWN:
        if kind == "notice":
            notices[plain(t)].add(name)
    rng = random.Random(9)
    pool = [t for _, kind, t in licenses.KNOWN if kind == "notice"]
    given = [(i, "\n".join(rng.choice(("words here", rng.choice(pool), f"* {rng.choice(pool).upper()} *", rng.choice(pool) + " indeed", ""))  for _ in range(rng.randint(0, 8)))) for i in range(200)]
    expected = [(i, ",".join(sorted({min(notices[plain(line)]) for line in t.split("\n") if plain(line) in notices}))) for i, t in given]
    assert got(licenses.scan(spark.createDataFrame(rows_of(given), SCHEMA)), "doc_id", "notices") == sorted(expected, key=repr)


# ---- embeddings -----------------------------------------------------------------------------------


def vector_rows(seed=0, dim=16):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(120):
        out.append((i, rng.normal(size=dim).tolist()))
    for g in range(6):
        centre = rng.normal(size=dim)
        out += [(1000 + 100 * g + i, (centre + rng.normal(size=dim) * 0.15 * (g + 1) / 3).tolist()) for i in range(40)]
    out += [(5000 + i, out[3][1]) for i in range(4)] + [(5100, [2 * x for x in out[3][1]]), (5200, [-x for x in out[3][1]])]
    out += [(6000, None), (6001, []), (6002, [0.0] * dim), (6003, [float("nan")] + [1.0] * (dim - 1)), (6004, [None] + [1.0] * (dim - 1)), (6005, [float("inf")] * dim), (6006, [1.0, 2.0]), (6007, [2.0, 4.1]), (7, out[7][1])]
    return out


def plain_links(rows, least):
    unit = []
    for _, v in rows:
        ok = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    hit = lambda i, j: unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= least
    roots = plain_components(len(rows), hit)
    links = [sum(hit(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    first = collections.defaultdict(list)
    for (i, _), r in zip(rows, roots):
        first[r].append(i)
    return sorted(((i, n, min(first[r]), i == min(first[r])) for (i, _), n, r in zip(rows, links, roots)), key=repr)


@pytest.mark.parametrize("block", [32768, 512])
def test_embeddings(spark, block):
    rows = vector_rows()
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<double>, label string, links int").repartition(3)
    assert got(embed_dedup.near_duplicates(table, sample=64, block=block), "vec_id", "n_links", "component_id", "kept") == plain_links(rows, 0.95)
    assert embed_dedup.near_duplicates(table.limit(0)).count() == 0


def near_points(rng, n, cos, dim=64):
    """Unit vectors whose pairs have a cosine near ``cos``."""
    centre = rng.normal(size=dim)
    x = centre / np.linalg.norm(centre) * math.sqrt(cos) + rng.normal(size=(n, dim)) * math.sqrt((1 - cos) / dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_dense_groups_at_the_threshold_take_seconds():
    rng = np.random.default_rng(5)
    x = np.concatenate([near_points(rng, 4000, 0.95), near_points(rng, 4000, 0.95), near_points(rng, 500, 0.999), rng.normal(size=(200, 64))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    start = time.process_time()
    tree = embed_dedup.CoverTree(x, math.acos(0.95) / 16)
    ones = np.ones(len(x))
    own = embed_dedup.traverse(tree, tree, ones, ones, 0.95, True)
    took = time.process_time() - start
    links = np.concatenate([(x[at : at + 1000] @ x.T >= 0.95).sum(axis=1) - 1 for at in range(0, len(x), 1000)])
    assert own.links.tolist() == links[tree.order].tolist() and took < 30
    assert len({own.root(i) for i in range(len(x))}) == 203


@pytest.mark.parametrize("seed", range(4))
def test_traversal_of_groups_of_all_sizes(seed):
    """Groups from far within the threshold to far beyond it, met by themselves and by others, against all pairs."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([near_points(rng, int(rng.integers(1, 400)), rng.uniform(0.85, 0.9999), 24) for _ in range(8)] + [rng.normal(size=(300, 24))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x[rng.permutation(len(x))]
    w, cut = rng.integers(1, 4, len(x)).astype(float), len(x) // 3
    cos = x @ x.T >= 0.95
    np.fill_diagonal(cos, False)
    roots = plain_components(len(x), lambda i, j: cos[i, j])
    tree = embed_dedup.CoverTree(x, 0.02)
    own = embed_dedup.traverse(tree, tree, w[tree.order], w[tree.order], 0.95, True)
    assert np.allclose(own.links, (cos @ w)[tree.order])
    groups = collections.defaultdict(set)
    for k, i in enumerate(tree.order.tolist()):
        groups[own.root(k)].add(roots[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(roots))
    a, b = embed_dedup.CoverTree(x[:cut], 0.02), embed_dedup.CoverTree(x[cut:], 0.02)
    met = embed_dedup.traverse(a, b, w[:cut][a.order], w[cut:][b.order], 0.95, False)
    between = cos[:cut, cut:]
    assert np.allclose(met.links, np.concatenate([(between @ w[cut:])[a.order], (w[:cut] @ between)[b.order]]))
    up = plain_components(len(x), lambda i, j: (i < cut) != (j < cut) and cos[i, j])
    for k, i in enumerate([*a.order.tolist(), *(cut + b.order).tolist()]):
        groups[met.root(k), "met"].add(up[i])
    assert all(len(g) == 1 for key, g in groups.items() if isinstance(key, tuple))


def test_cells_split_until_they_are_small(spark):
    """Many groups and small blocks: several rounds of pivots, and hash parts once these are used up."""
    rng = np.random.default_rng(9)
    x = np.concatenate([near_points(rng, 60, 0.96, 12) for _ in range(40)])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(3)
    expected = plain_links([(i, v.tolist()) for i, v in enumerate(x)], 0.95)
    for most in (64, 3):
        assert got(embed_dedup.near_duplicates(table, sample=200, block=100, most_pivots=most), "vec_id", "n_links", "component_id", "kept") == expected


@pytest.mark.parametrize("least", [0.5, 0.9, 0.99])
def test_dual_traversal(least):
    rows = [r for r in vector_rows(2) if r[1] and len(r[1]) == 16 and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = embed_dedup.CoverTree(x[:150], 0.02), embed_dedup.CoverTree(x[150:], 0.02)
    wa, wb = np.arange(1.0, 151), np.ones(len(x) - 150)
    tally = embed_dedup.traverse(a, b, wa[a.order], wb, least, False)
    cos = x[:150] @ x[150:].T >= least
    assert tally.links[:150].tolist() == (cos @ wb)[a.order].tolist() and tally.links[150:].tolist() == (wa @ cos)[b.order].tolist()
    own = embed_dedup.traverse(a, a, wa[a.order], wa[a.order], least, True)
    cos = x[:150] @ x[:150].T >= least
    np.fill_diagonal(cos, False)
    assert own.links.tolist() == (cos @ wa)[a.order].tolist()


# ---- toxicity ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def insults(spark):
    from tests.llm.conftest import words

    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 7 == 0
        body = words(rng, rng.randint(8, 60)).split()
        for _ in range(2 if toxic else 0):
            body.insert(rng.randrange(len(body)), rng.choice(("zonker", "grobian", "mufflish", "mufflingen")))
        poor = i % 5 == 1
        rows.append((i, "!! ".join(body).upper() if poor else " ".join(body)))
        labels.append((i, int(not poor), int(toxic)))
    rows += [(2000, None), (2001, ""), (3, rows[3][1])]
    return spark.createDataFrame(rows_of(rows), SCHEMA), spark.createDataFrame([*labels, (None, 1, 1), (5000, None, None)], "doc_id bigint, quality int, toxic int")


def test_toxicity(insults, no_docs):
    docs, labels = insults
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model, passages=True).join(labels.select("doc_id", "toxic"), "doc_id", "left").collect()
    held = [r for r in out if r["held_out"] and r["toxic"] is not None]
    right = sum(r["predicted"] == r["toxic"] for r in held) / len(held)
    assert right > 0.97 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    empty = [r for r in out if r["doc_id"] in (2000, 2001)]
    assert len(empty) == 2 and all(r["predicted"] == 0 for r in empty)
    for r in out:
        for p in r["passages"]:
            assert any(w in r["row"]["text"][p["start"] : p["end"]].lower() for w in ("zonker", "grobian", "muffl"))
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.score(docs, toxicity.fit(no_docs, labels)).count() == docs.count()
    assert {r["predicted"] for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0}


def plain_segments(value, a, b):
    """The best run of value[a:b], then those left and right of it; no two runs here have one total."""
    best = max(((sum(value[i:j]), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0.0, a, a))
    if best[0] <= 0:
        return []
    return plain_segments(value, a, best[1]) + [(best[1], best[2], best[0])] + plain_segments(value, best[2], b)


def test_segments_are_maximal():
    model = toxicity.Model({"bad": 2.0, "worse": 3.0}, -0.5)
    found, n = model.segments("bad ok worse " + "ok " * 20 + "worse bad")
    assert n == 25 and found == [(0, 3, 4.5), (23, 25, 5.0)]
    rng = random.Random(2)
    names = ["".join(p) for p in itertools.product("abcdef", repeat=2)]
    weights = {w: rng.uniform(0.2, 3.0) for w in names[:12]}
    for _ in range(300):
        model = toxicity.Model(weights, -rng.uniform(0.1, 2.0))
        tokens = [rng.choice(names) for _ in range(rng.randint(1, 28))]
        value = [weights.get(t, model.other) for t in tokens]
        found, _ = model.segments(" ".join(tokens))
        expected = plain_segments(value, 0, len(value))
        assert [f[:2] for f in found] == [x[:2] for x in expected] and all(abs(f[2] - x[2]) < 1e-9 for f, x in zip(found, expected))
    # ties: the best total is the best total
    model = toxicity.Model({"bad": 2.0, "worse": 3.0}, -0.5)
    for _ in range(200):
        tokens = [rng.choice(("bad", "worse", "ok", "ok", "ok")) for _ in range(rng.randint(1, 30))]
        value = [{"bad": 2.0, "worse": 3.0}.get(t, -0.5) for t in tokens]
        best = max([sum(value[i:j]) for i in range(len(value)) for j in range(i + 1, len(value) + 1)], default=0)
        top = max((s for *_, s in model.segments(" ".join(tokens))[0]), default=0.0)
        assert abs(top - max(best, 0)) < 1e-9


def test_segments_take_linear_time():
    """Isolated hits, rising ones and falling ones: work grows with the text."""
    for gap, weights in ((5, {"bad": 2.0}), (3, {"bad": 2.0}), (9, {"bad": 2.0})):
        model = toxicity.Model(weights, -0.5)
        took = []
        for n in (20_000, 80_000):
            text = ("bad " + "ok " * gap) * n
            model.segments("warm")
            start = time.process_time()
            found, _ = model.segments(text)
            took.append(time.process_time() - start)
        assert took[1] < 12 * took[0] + 0.2


def test_toxicity_scores_by_the_documented_rule(insults):
    """Every score of the table is the logistic curve over the plain segments' best, its rarity and the significant total."""
    docs, labels = insults
    model = toxicity.fit(docs, labels)
    for r in toxicity.score(docs, model).where("doc_id % 9 = 0").collect():
        words = re.findall(r"[^\W\d_]+", (r["row"]["text"] or "").lower())
        value = [max([model.weights[f] for f in toxicity.features(w) if f in model.weights], default=model.other) for w in words]
        found = [s for *_, s in plain_segments(value, 0, len(value))]
        best, n = max(found, default=0.0), max(len(words), 1)
        rare = lambda s: 1 - math.exp(-model.k * n * math.exp(-model.lam * s)) if s > 0 else 1.0  # noqa: B023, E731
        x = model.curve[0] + model.curve[1] * best - model.curve[2] * math.log(max(rare(best), 1e-300)) + model.curve[3] * math.log1p(sum(s for s in found if rare(s) <= model.alpha))
        assert abs(r["score"] - 1 / (1 + math.exp(-min(max(x, -30), 30)))) < 1e-6


# ---- mixing ---------------------------------------------------------------------------------------


def test_mixing_meets_targets(spark, insults, no_docs):
    docs, labels = insults
    targets = {"good": 0.6, "poor": 0.1, "toxic": 0.3}
    rows = mixing.mix(docs, labels, targets).collect()
    assert len(rows) == docs.count() and all(r["rate"] >= 0 and abs(r["p_good"] + r["p_poor"] + r["p_toxic"] - 1) < 1e-9 for r in rows)
    total = sum(r["n_tokens"] for r in rows)
    for d in mixing.DOMAINS:
        assert abs(sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in rows) / total - targets[d]) < 0.02
    short = mixing.repeated(mixing.mix(docs, labels, targets))
    assert short.columns == docs.columns and 0 < short.count() < 2 * docs.count()
    # documents of a domain to keep stay, and the mix grows where they exceed their target
    grown = mixing.mix(docs, labels, targets, keep="good").cache()
    assert grown.where("rate < 1 and p_good >= 0.5").count() == 0 and grown.where("rate < 0.5 and p_poor >= 0.5").count() > 0
    assert grown.selectExpr("sum(rate * n_tokens) / sum(n_tokens)").first()[0] > 1.1
    assert mixing.mix(no_docs, labels).count() == 0 and mixing.repeated(mixing.mix(no_docs, labels.limit(0))).count() == 0
    assert {round(r["rate"], 6) >= 0 for r in mixing.mix(docs, labels.limit(0)).collect()} == {True}


# ---- components -----------------------------------------------------------------------------------


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (7, 7), (300, 301), (300, 302), (300, 303), (None, 4), (303, 301)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 200: 100} | {i: 300 for i in range(300, 304)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0
