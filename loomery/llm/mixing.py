"""Mixing to target weights with soft domains.

A softmax classifier, fitted on a bounded sample of the labelled table, gives
every document a posterior over domains: good, poor, toxic. Rates are then fitted
to all documents: nonnegative r with sum_i r_i n_i p_i = T, where n_i are a
document's tokens, p_i its posterior and T the target totals, by projected
gradient on the squared distance of both sides. A document's gradient, in the
metric of its tokens, is p_i . y with one small y for all, so a step is a pass
that sums a few vectors over the corpus. A pass goes through the steps so far,
r <- max(0, r + p . y), in its tasks; only its sums reach the driver. The fitted rates
are a chain of such column expressions.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from loomery.llm.store import few, fields_and, written

DOMAINS = ("good", "poor", "toxic")
BUCKETS, MEMO = 512, 300_000
PUNCT = re.compile(r"[^\w\s]")


@dataclass
class Classifier:
    """Plain values; travels with the code. ``weights`` is features x domains."""

    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    _memo: dict = field(default_factory=dict, repr=False)

    def posteriors(self, texts: list[str]) -> np.ndarray:
        x = (np.array([describe(t, self._memo) for t in texts]).reshape(-1, len(self.mean)) - self.mean) / self.scale
        z = np.column_stack([np.ones(len(x)), x]) @ self.weights
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_memo": {}}


def describe(text: str, memo: dict[str, int]) -> np.ndarray:
    """Shape features of a text, and hashed shares of the words it holds."""
    words = text.split()
    n, chars = len(words), max(len(text), 1)
    kinds = set(words)
    if len(memo) > MEMO:
        memo.clear()
    for w in kinds.difference(memo):
        memo[w] = xxhash.xxh32_intdigest(w.strip(".,!?").lower().encode()) % BUCKETS
    there = np.zeros(BUCKETS)
    there[[memo[w] for w in kinds]] = 1.0
    letters = sum(map(str.isalpha, words))
    lines = text.split("\n")
    shape = [np.log1p(n), chars / max(n, 1), len(kinds) / max(n, 1), letters / max(n, 1), text.count("|") / max(n, 1), text.count("!") / max(n, 1), len(PUNCT.findall(text)) / chars, sum(map(str.isupper, words)) / max(n, 1), len(set(lines)) / len(lines), n / len(lines)]
    return np.concatenate([np.log1p(shape), there])


def token_count(text: Column) -> Column:
    """Words between ASCII white space; the mixing budget is in these."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("bigint")


def fit_classifier(docs: DataFrame, labels: DataFrame, sample: int = 6000, rounds: int = 300, ridge: float = 1e-3) -> Classifier:
    """Softmax regression on the documents of at most ``sample`` labels, taken in the order of a hash of their ids.

    One label an id counts, the worst; of documents that share an id one, that with the smallest text.
    """
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0).cast("int").alias("domain")
    drawn = labels.where("doc_id is not null and toxic in (0, 1) and quality in (0, 1)").select(F.col("doc_id").cast("bigint").alias("doc_id"), domain)
    drawn = drawn.groupBy("doc_id").agg(F.max("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # bounded by ``sample``
    rows = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "domain").agg(F.min("text").alias("text")).select("doc_id", "text", "domain")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        for batch in batches:
            x = [describe(t or "", memo).astype(np.float32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary()), batch.column(2)], ["doc_id", "x", "domain"])

    table = rows.mapInArrow(run, "doc_id bigint, x binary, domain int").toArrow().sort_by("doc_id")
    k = len(DOMAINS)
    width = len(describe("", {}))
    if not len(table):
        return Classifier(np.zeros((width + 1, k)), np.zeros(width), np.ones(width))
    y = np.eye(k)[table.column("domain").to_numpy()]
    # one matrix on the driver, changed in place
    x = np.ones((len(table), width + 1))
    for i, features in enumerate(table.column("x")):
        x[i, 1:] = np.frombuffer(features.as_buffer(), np.float32)
    del table
    mean = x[:, 1:].mean(axis=0)
    x[:, 1:] -= mean
    scale = np.sqrt(np.einsum("ij,ij->j", x[:, 1:], x[:, 1:]) / len(x))
    scale[scale < 1e-9] = 1.0
    x[:, 1:] /= scale
    w = np.zeros((x.shape[1], k))
    w[0] = np.log(y.mean(axis=0) + 1e-3)
    step = 1.0 / (0.5 * np.linalg.eigvalsh(x.T @ x)[-1] / len(x) + ridge)
    before = w.copy()
    for t in range(rounds):  # accelerated gradient
        v = w + t / (t + 3) * (w - before)
        z = x @ v
        z = np.exp(z - z.max(axis=1, keepdims=True))
        grad = x.T @ (z / z.sum(axis=1, keepdims=True) - y) / len(x) + ridge * np.r_[np.zeros((1, k)), v[1:]]
        before, w = w, v - step * grad
    return Classifier(w, mean, scale)


def domain_posteriors(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (struct of all input columns), doc_id, n_tokens, p_good, p_poor, p_toxic."""
    text = F.col(text_col).cast("string")
    given = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), token_count(text).alias("n_tokens"))
    names = [f"p_{d}" for d in DOMAINS]
    schema = fields_and(given.schema.fields, ", ".join(f"{n} double" for n in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            # the text is a field of the row and travels once
            p = classifier.posteriors([t or "" for t in batch.column(0).field(text_col).cast(pa.string()).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(p[:, i].copy()) for i in range(len(names)))], schema.fieldNames())

    return given.mapInArrow(run, schema)


#: Lengths tried for each step; one pass sums the outcome of all of them.
LENGTHS = (1.0, 0.5, 0.2, 0.05, 0.01)


#: A share of the mix that is off its target by more is logged.
MISSED = 0.005


def growth_to_keep(weighed: DataFrame, targets: dict[str, float], least: Column) -> float:
    """Growth at which the tokens that documents have at their ``least`` rates fit under every domain's target; 1 at least.

    A domain of weight 0 is left aside: no growth makes room for what it has.
    """
    n, names = F.col("n_tokens").cast("double"), [d for d in DOMAINS if targets[d] > 0]
    row = weighed.agg(F.sum(n), *(F.sum(n * least * F.col(f"p_{d}")) for d in names)).first()
    total, all_ = float(row[0] or 0.0), sum(targets.values())
    return max([1.0, *(float(v) * all_ / (targets[d] * total) for d, v in zip(names, row[1:]))]) if total else 1.0


def _along(p: Sequence, y: np.ndarray) -> Column | np.ndarray:
    """p . y by documents, for columns of a table as for arrays, added in one order."""
    return sum((float(v) * q for v, q in zip(y, p)), 0.0)


def _sums(numbers: DataFrame, steps: list[np.ndarray], of: Callable[..., list[np.ndarray]], width: int) -> np.ndarray:
    """Sums over the table n, p_good, p_poor, p_toxic, least of the ``width`` numbers that ``of`` gives a batch with its rates after ``steps``.

    The steps travel with the code: the plan is the same however many there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(width)
        for batch in batches:
            n, *p, least = (c.to_numpy() for c in batch.columns)
            r = np.maximum(least, 1.0)
            for y in steps:
                r = np.maximum(least, r + _along(p, y))
            found += of(n, np.array(p), least, r)
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in found], names)

    names = [f"s{i}" for i in range(width)]
    row = numbers.mapInArrow(run, ", ".join(f"{c} double" for c in names)).agg(*(F.sum(c) for c in names)).first()
    return np.array([float(v or 0.0) for v in row])


def fit_rates(weighed: DataFrame, targets: dict[str, float], growth: float = 1.0, least: Column | float = 0.0, tolerance: float = 1e-6, most_steps: int = 40) -> tuple[Column, dict[str, float]]:
    """Column of rates for a table with n_tokens and posteriors, and the residual.

    ``targets`` are weights of a mix of ``growth`` times the tokens there are; no
    rate goes below ``least``, a number or a column of the table. Steps go along the
    gradient, plain and in the metric of the documents above the bound, as far as the
    distance shrinks most; targets that no such rates reach end at the nearest found.
    The residual is what each domain's tokens lack to its target, as a share of the
    wanted mix; it is logged where it is more than ``MISSED``. The rounds read a table
    of numbers only.
    """
    p = [F.col(f"p_{d}") for d in DOMAINS]
    k = len(DOMAINS)
    want = growth * np.array([targets[d] for d in DOMAINS]) / sum(targets.values())
    bound = least if isinstance(least, Column) else F.lit(float(least))
    numbers = written(weighed.select(F.col("n_tokens").cast("double").alias("n"), *p, bound.alias("least")).na.fill(0.0), "numbers")
    upper = np.triu_indices(k)
    steps: list[np.ndarray] = []
    total, *got = _sums(numbers, steps, lambda n, p, least, r: [n.sum(), *(p @ (n * r))], 1 + k)
    got = np.array(got)
    for _ in range(most_steps if total else 0):
        short = want - got / total
        if np.abs(short).max() <= tolerance:
            break

        def products(n: np.ndarray, p: np.ndarray, least: np.ndarray, r: np.ndarray, short: np.ndarray = short) -> np.ndarray:
            # a document at the bound takes part where the gradient leads away from it
            live = np.where((r > least) | (_along(p, short) > 0), n, 0.0)
            return ((live * p) @ p.T)[upper]

        gram = np.zeros((k, k))
        gram[upper] = _sums(numbers, steps, products, len(upper[0])) / total
        gram = gram + np.triu(gram, 1).T
        ways = [np.linalg.lstsq(gram + 1e-9 * np.eye(k), short, rcond=1e-10)[0], short / max(np.linalg.norm(gram, 2), 1e-9)]
        tried = [t * y for y in ways for t in LENGTHS]

        def outcomes(n: np.ndarray, p: np.ndarray, least: np.ndarray, r: np.ndarray, tried: list[np.ndarray] = tried) -> np.ndarray:
            return np.concatenate([p @ (n * np.maximum(least, r + _along(p, y))) for y in tried])

        sums = _sums(numbers, steps, outcomes, len(tried) * k).reshape(len(tried), k)
        away = np.linalg.norm(want - sums / total, axis=1)
        best = int(away.argmin())
        if away[best] >= np.linalg.norm(short) * (1 - 1e-4):
            break
        steps.append(tried[best])
        got = sums[best]
    rate = F.greatest(bound, F.lit(1.0))
    for y in steps:
        rate = F.greatest(bound, rate + _along(p, y))
    residual = dict(zip(DOMAINS, ((want - got / total) / growth).tolist() if total else [0.0] * k))
    if max(map(abs, residual.values())) > MISSED:
        logging.getLogger(__name__).warning("targets not met, lacking shares of the mix: %s", residual)
    return rate, residual


#: Target weights of good, poor and toxic documents in tokens.
TARGETS = {"good": 0.85, "poor": 0.12, "toxic": 0.03}


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, sample: int = 6000, id_col: str = "doc_id", text_col: str = "text", growth: float = 1.0, keep: str | None = None) -> DataFrame:
    """row, doc_id, n_tokens, p_good, p_poor, p_toxic, rate for every row.

    rate (0 or more) is how often a document goes into the mix. A null or empty
    text has no tokens, and the rate its posteriors give. Without labels
    posteriors are equal and rates 1. Repeated rows count each for itself, a null id is
    kept; an empty table gives no rows; input columns of any name stay in ``row``.
    With ``keep``, a domain, documents that most likely are of it have rates of 1 at
    least, and the mix grows beyond ``growth`` if they alone exceed a target.
    """
    classifier = fit_classifier(docs, labels, sample)
    weighed = written(domain_posteriors(docs, classifier, id_col, text_col), "posteriors")
    least = F.when(F.col(f"p_{keep}") >= 0.5, 1.0).otherwise(0.0) if keep else F.lit(0.0)
    if keep:
        growth = max(growth, growth_to_keep(weighed, targets or TARGETS, least))
    return weighed.withColumn("rate", fit_rates(weighed, targets or TARGETS, growth, least)[0])


def repeated(mixed: DataFrame, seed: int = 9) -> DataFrame:
    """The mix itself, as rows of the input: whole copies by rate, the fraction by a hash of the id.

    A rate of 1 or more keeps a document for certain.
    """
    chance = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    copies = F.floor(F.col("rate") + chance).cast("int")
    return mixed.where(copies > 0).select("row", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).select("row.*")
