import collections

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from loomery.llm import bpe, line_dedup, mixing, toxicity
from tests.llm.conftest import words

import random
import tracemalloc

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages(spark, tmp_path):
    rng = random.Random(3)
    body = {i: words(rng, rng.randint(30, 80)) for i in range(400)}
    for i in range(0, 400, 8):
        body[i] += " zonker grobian"
    body[401] = body[1]  # an exact copy
    body[402] = "\n".join([words(rng, 40), body[5], words(rng, 30)])  # repeats another document's line
    body[403], body[404] = None, ""
    rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in body.items()]
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i % 5 > 0), int(i % 8 == 0)) for i in range(400)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == COLUMNS.replace(" bigint", "").replace(" string", "").split(", ")
        kept.append({r["doc_id"]: r for r in docs.collect()})
    toxic, lines, near, mixed, tokens = kept
    assert not any(i in toxic for i in range(0, 400, 8)) and {1, 2, 3, 401, 402, 403, 404} <= set(toxic)
    assert set(lines) == set(toxic) and lines[401]["text"] == "" and body[5] not in lines[402]["text"] and lines[402]["n_chars"] == len(lines[402]["text"])
    assert 401 not in near or sum(i in near for i in (401, 403, 404)) == 1
    assert {1, 2, 3, 5, 402} <= set(near) and set(near) >= set(mixed) == set(tokens)
    # documents labelled good stay, whatever the rates of others
    assert {i for i in near if i < 400 and i % 5} <= set(mixed)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert all(list(tokens[i]["ids"]) == plain.encode_ordinary(mixed[i]["text"] or "") for i in tokens)
    whole = [repr(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert collections.Counter(whole) == collections.Counter(repr(r) for r in docs.collect())


def test_stages_hand_python_few_rows_at_once(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text")).coalesce(1)
    sizes = lambda: docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [len(b)]}) for b in batches), "n bigint").agg(F.max("n"), F.sum("n")).first()
    try:
        spark.conf.set(key, 10_000)
        assert corpus_pipeline.tokenise(spark, docs, str(tmp_path)).count() == 9000
        most, rows = sizes()
        assert most <= 2000 and rows == 9000
        spark.conf.set(key, 500)
        corpus_pipeline.tokenise(spark, docs, str(tmp_path))
        assert sizes()[0] <= 500
    finally:
        spark.conf.set(key, before)


def test_odd_tables(spark, tmp_path):
    """An empty table, null ids, repeated rows and further columns with the names that stages use."""
    labels = spark.createDataFrame([(i, 1, int(i == 2)) for i in range(4)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    more = COLUMNS + ", row string, kept string, drops string, rate double, score double, copy int, ids string"
    odd = [(i, t, "en", "s", 3, "x", "x", "x", 0.0, 0.0, 1, "x") for i, t in ((None, "some words here"), (None, None), (1, "one two three four"), (1, "one two three four"), (2, "bad bad"), (3, ""))]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, more)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        found = corpus_pipeline.tokenise(spark, docs, str(tmp_path)).collect()
        assert {r["doc_id"] for r in found} <= {None, 1, 2, 3} and bool(found) == bool(rows)


def test_mix_meets_targets_on_skewed_input(spark, tmp_path):
    rng = random.Random(4)
    body = {i: words(rng, rng.randint(20, 80)) for i in range(600)}
    body = {i: "!! ".join(t.split()).upper() if i % 3 == 0 else t for i, t in body.items()}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in body.items()], COLUMNS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in body], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    mixed = corpus_pipeline.mix_to_targets(spark, docs, str(tmp_path))
    weighed = mixing.domain_posteriors(mixed, mixing.fit_classifier(docs, labels)).collect()
    assert {i for i in body if i % 3} <= {r["doc_id"] for r in weighed}
    total = sum(r["n_tokens"] for r in weighed)
    for d, target in corpus_pipeline.TARGETS.items():
        assert abs(sum(r["n_tokens"] * r[f"p_{d}"] for r in weighed) / total - target) < 0.02
    # poor documents are thinned out, most of them by far
    assert len({r["doc_id"] for r in weighed if r["doc_id"] % 3 == 0}) < 120


def test_rates_against_nonnegative_least_squares(spark):
    """Residuals are those of a plain projected gradient run to its end, where targets are in reach and where they aren't."""
    rng = np.random.default_rng(3)
    for targets, growth, least in (((0.6, 0.3, 0.1), 1.0, 0.0), ((0.1, 0.1, 0.8), 1.0, 0.0), ((0.9, 0.1, 0.0), 1.2, 1.0)):
        p = rng.dirichlet((4.0, 1.0, 0.3), 80)
        n = rng.integers(1, 200, 80).astype(float)
        a, want = (p * n[:, None]).T / n.sum(), growth * np.array(targets)
        r, scaled = np.maximum(np.ones(80), least), a / np.sqrt(n)
        for _ in range(60_000):
            r = np.maximum(least, r - (a.T @ (a @ r - want)) / n * (0.9 * n.sum() / np.linalg.norm(scaled * np.sqrt(n.sum()), 2) ** 2))
        table = spark.createDataFrame([(int(c), *map(float, q)) for c, q in zip(n, p)], "n_tokens bigint, p_good double, p_poor double, p_toxic double")
        rate, residual = mixing.fit_rates(table, dict(zip(mixing.DOMAINS, targets)), growth, least)
        got = np.array([x["r"] for x in table.select(rate.alias("r")).collect()])
        assert got.min() >= least and np.linalg.norm(list(residual.values())) * growth <= 1.05 * np.linalg.norm(a @ r - want) + 2e-3
        assert np.allclose((want - a @ got) / growth, list(residual.values()), atol=1e-9)


def test_plans_of_the_rounds_do_not_grow(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(c), *map(float, q)) for c, q in zip(rng.integers(1, 200, 80), rng.dirichlet((4.0, 1.0, 0.3), 80))]
    table = spark.createDataFrame(rows, "n_tokens bigint, p_good double, p_poor double, p_toxic double")
    sizes, kind = [], type(table)
    monkeypatch.setattr(kind, "first", lambda self, real=kind.first: sizes.append(len(self._jdf.queryExecution().analyzed().toJSON())) or real(self))
    mixing.fit_rates(table, {"good": 0.1, "poor": 0.1, "toxic": 0.8}, tolerance=0.0)
    assert len(sizes) >= 9 and max(sizes) < 1.05 * max(sizes[:3])


def test_the_classifier_takes_one_matrix_on_the_driver(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, words(rng, 30)) for i in range(1500)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1500)], "doc_id bigint, quality int, toxic int")
    tracemalloc.start()
    try:
        model = mixing.fit_classifier(docs, labels, rounds=5)
        assert tracemalloc.get_traced_memory()[1] < 2.5 * 1500 * 8 * len(model.weights)
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("stage", ["toxicity", "lines", "mixing"])
def test_workers_give_few_rows_at_a_time(spark, monkeypatch, stage):
    rows = [(i, f"line {i} of some text\na line that they all share", "en", "web", 9) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1)
    calls, kind = [], type(docs)
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, *a, real=kind.mapInArrow, **k: calls.append((self, f)) or real(self, f, *a, **k))
    if stage == "toxicity":
        toxicity.score(docs, toxicity.Model({"text": 1.0}, -0.1))
    elif stage == "lines":
        line_dedup.dedup_lines(docs)
    else:
        width = len(mixing.describe("", {}))
        mixing.domain_posteriors(docs, mixing.Classifier(np.zeros((width + 1, 3)), np.zeros(width), np.ones(width)))
    for given, f in calls:
        out = list(f(iter(given.toArrow().combine_chunks().to_batches())))
        assert len(out) >= 3 and (stage == "lines" or max(map(len, out)) <= 256)
    assert sum(map(len, out)) == 700 and max(map(len, out)) <= 256
