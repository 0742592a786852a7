"""Toxicity by maximum-scoring segments of token log-odds.

Fit: labelled documents (a bounded, class-balanced sample of the labels; see
``per_class``) give, for each word and each four-letter word beginning, the
number of different preceding words in toxic and in clean documents. Counting
contexts instead of occurrences keeps copies of one document from passing for
evidence. Log-odds have a Dirichlet prior in proportion to the pooled counts;
those that stand out (``least_odds``, ``least_z``) become positive scores, all
other tokens get one common negative score, the log ratio of their total rates.

Score: one linear scan finds every maximal segment of positive total. A clean
text of n tokens holds a segment of score s or more with probability
1 - exp(-K n exp(-lambda s)); lambda solves the usual equation over clean token
scores, and K is fitted to the maxima of clean training documents. A logistic
curve over the best segment's score and significance, and the total of the
significant ones, gives the probability, corrected to the labels' base rate.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from loomery.llm.store import few, fields_and, written

WORD = re.compile(r"[^\W\d_]+")
PREFIX, FLUSH, MEMO = 4, 200_000, 400_000


def features(word: str) -> tuple[str, ...]:
    return (word, word[:PREFIX] + "*") if len(word) > PREFIX else (word,)


@dataclass
class Model:
    """Plain values only; it travels to the workers with the code."""

    weights: dict[str, float]
    other: float
    lam: float = 1.0
    k: float = 1.0
    curve: tuple[float, ...] = (-2.0, 1.0, 0.0, 0.0)
    alpha: float = 0.01

    def segments(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        """All maximal segments (first token, token after the last, score) in text order, and the number of tokens."""
        words = WORD.findall(text.lower())
        memo = self.__dict__.setdefault("_memo", {})
        if len(memo) > MEMO:
            memo.clear()
        weights = self.weights
        for w in set(words).difference(memo):
            memo[w] = max([weights[f] for f in features(w) if f in weights], default=0.0)
        # candidates: (start, end, total before it, total after it, the last candidate left of it with a lower total before)
        stack: list[tuple[int, int, float, float, int]] = []
        total, last = 0.0, 0
        for i, v in [(i, v) for i, w in enumerate(words) if (v := memo[w])]:
            before = total + self.other * (i - last)
            total, last = before + v, i + 1
            start, low, j = i, before, len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            while j >= 0 and stack[j][3] < total:
                # the segment grows leftward over candidate j and all since
                start, _, low, _, left = stack[j]
                del stack[j:]
                j = left
            stack.append((start, i + 1, low, total, j))
        return [(a, b, after - before) for a, b, before, after, _ in stack], len(words)

    def p_value(self, score: float, tokens: int) -> float:
        return -math.expm1(-self.k * max(tokens, 1) * math.exp(-self.lam * score)) if score > 0 else 1.0

    def evidence(self, text: str) -> tuple[float, float, float]:
        found, n = self.segments(text)
        best = max((s for *_, s in found), default=0.0)
        strong = sum(s for *_, s in found if self.p_value(s, n) <= self.alpha)
        return best, -math.log(max(self.p_value(best, n), 1e-300)), math.log1p(strong)

    def score(self, text: str) -> float:
        x = self.curve[0] + sum(c * e for c, e in zip(self.curve[1:], self.evidence(text)))
        return 1 / (1 + math.exp(-min(max(x, -30.0), 30.0)))

    def passages(self, text: str) -> list[tuple[int, int, float, float]]:
        """Significant segments as characters: (start, end, score, p-value)."""
        found, n = self.segments(text)
        keep = [(a, b, s, p) for a, b, s in found if (p := self.p_value(s, n)) <= self.alpha]
        if not keep:
            return []
        # lower-casing can change lengths; places are taken from the text as it is, where the words agree
        spans = [m.span() for m in WORD.finditer(text)]
        if len(spans) != n:
            spans = [m.span() for m in WORD.finditer(text.lower())]
        return [(spans[a][0], spans[b - 1][1], s, p) for a, b, s, p in keep]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_memo"}


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, float]:
    """(text, toxic) of the sampled training documents, and the base rate of all training labels.

    Labels with crc32(doc_id) mod 4 = 2 are held out. The sample takes ``per_class``
    documents of each class, in the order of a hash of their ids. Null ids or labels are no labels.
    """
    ids = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = ids.where("doc_id is not null and toxic in (0, 1) and crc32(cast(doc_id as string)) % 4 <> 2").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rate = usable.agg(F.avg("toxic")).first()[0]
    sample = None
    for label in (0, 1):
        part = usable.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        sample = part if sample is None else sample.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most 2 * per_class pairs of numbers: a bounded broadcast
    return texts.join(F.broadcast(sample), "doc_id").select("text", "toxic"), float(rate or 0.0)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: set) -> pa.RecordBatch:
        f, c, t = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(c, pa.int32()), pa.array(t, pa.int32())], ["feature", "context", "toxic"])

    rows: set[tuple[str, int, int]] = set()
    for batch in batches:
        for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
            before = 0
            for w in WORD.findall((text or "").lower()):
                rows.update([(f, before, toxic) for f in features(w)])
                before = xxhash.xxh32_intdigest(w.encode()) >> 1
            if len(rows) > FLUSH:
                yield batch_of(rows)
                rows = set()
    if rows:
        yield batch_of(rows)


def _newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = 0.05 * np.r_[0.0, np.ones(len(w) - 1)]
        step = np.linalg.solve(x.T * (weight * p * (1 - p)) @ x + np.diag(ridge + 1e-6), x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 4000, prior: float = 0.5, least_odds: float = 1.5, least_z: float = 3.0) -> Model:
    """Fit on training labels only; without two classes the model scores every text by the base rate."""
    rows, rate = training_rows(docs, labels, per_class)
    rows = written(rows.repartition(max(12, rows.sparkSession.sparkContext.defaultParallelism)), "training")
    seen = rows.mapInArrow(_contexts, "feature string, context int, toxic int").distinct()
    counts = seen.groupBy("feature").agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("c"))
    counts = written(counts, "counts")
    totals = counts.agg(F.sum("a"), F.sum("c")).first()
    n1, n0 = (totals[0] or 0.0), (totals[1] or 0.0)
    base = math.log(max(rate, 1e-6) / max(1 - rate, 1e-6)) if 0 < rate < 1 else (20.0 if rate == 1 else -20.0)
    if not n1 or not n0:
        return Model({}, -0.1, curve=(base if rate else -20.0, 0.0, 0.0, 0.0))
    mine = F.lit(prior) + F.lit(prior * 100.0) * (F.col("a") + F.col("c")) / F.lit(n1 + n0)
    odds = F.log((F.col("a") + mine) / F.lit(n1)) - F.log((F.col("c") + mine) / F.lit(n0))
    scored = counts.withColumn("odds", odds).withColumn("z", F.col("odds") / F.sqrt(1 / (F.col("a") + mine) + 1 / (F.col("c") + mine)))
    kept = scored.where((F.col("odds") >= least_odds) & (F.col("z") >= least_z)).collect()  # bounded by the sample
    weights = {r["feature"]: r["odds"] for r in kept}
    p1, p0 = (sum(r[k] for r in kept) / n for k, n in (("a", n1), ("c", n0)))
    other = math.log(max(1 - p1, 0.01) / max(1 - p0, 0.01))
    model = Model(weights, min(other, -1e-4))
    # lambda: sum of p0(score) exp(lambda * score) = 1, with the prior's share for features unseen in clean text
    hits = [((r["c"] + prior) / n0, r["odds"]) for r in kept]
    rest = max(1 - sum(p for p, _ in hits), 0.01)
    low, high = 1e-6, 5.0
    for _ in range(60):
        mid = (low + high) / 2
        value = rest * math.exp(mid * model.other) + sum(p * math.exp(min(mid * s, 600.0)) for p, s in hits)
        low, high = (mid, high) if value < 1 else (low, mid)
    model.lam = max(low, 0.05)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [model.evidence(t.as_py() or "") for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*(pa.array([v[i] for v in values], pa.float64()) for i in range(3)), batch.column(1)], ["best", "rarity", "strong", "toxic"])

    def maxima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.segments(t.as_py() or "") for t in batch.column(0)]
            best = [max((s for *_, s in f), default=0.0) for f, _ in found]
            yield pa.RecordBatch.from_arrays([pa.array(best, pa.float64()), pa.array([n for _, n in found], pa.int64())], ["best", "n"])

    # expected clean documents with a maximum of ``at`` or more = K exp(-lambda at) sum(n)
    at = min(weights.values(), default=1.0)
    clean = rows.where("toxic = 0").mapInArrow(maxima, "best double, n bigint").agg(F.count_if(F.col("best") >= at), F.sum("n")).first()
    model.k = ((clean[0] or 0) + 0.5) / max((clean[1] or 0) * math.exp(-model.lam * at), 1e-9)
    table = rows.mapInArrow(measured, "best double, rarity double, strong double, toxic int").collect()  # four numbers of at most 2 * per_class rows
    table.sort(key=tuple)
    x = np.array([r[:3] for r in table])
    y = np.array([r["toxic"] for r in table], float)
    share = y.mean()
    curve = _newton(x, y, np.where(y == 1, rate / share, (1 - rate) / (1 - share)))
    model.curve = tuple(map(float, curve))
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", passages: bool = False) -> DataFrame:
    """row (struct of all input columns), doc_id, held_out, score, predicted; with ``passages`` also
    passages array<struct<start, end, score, p_value>> in characters.

    A null text scores as an empty one. A null id is not held out. Repeated rows
    give repeated rows, an empty table none; input columns of any name stay in ``row``.
    """
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
    given = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), held.alias("held_out"))
    schema = fields_and(
        given.schema.fields,
        "score double, predicted int" + ", passages array<struct<start:int,end:int,score:double,p_value:double>>" * passages,
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            # the text is a field of the row and travels once
            column = batch.column(0).field(text_col).cast(pa.string())
            values = [model.score(t.as_py() or "") for t in column]
            out = [*batch.columns, pa.array(values, pa.float64()), pa.array([int(v >= threshold) for v in values], pa.int32())]
            if passages:
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("p_value", pa.float64())]))
                out.append(pa.array([[dict(zip(("start", "end", "score", "p_value"), p)) for p in model.passages(t.as_py() or "")] for t in column], kind))
            yield pa.RecordBatch.from_arrays(out, schema.fieldNames())

    return given.mapInArrow(run, schema)
