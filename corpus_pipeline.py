"""Documents to training tokens: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomery.llm import bpe, jaccard, line_dedup, mixing, toxicity
from loomery.llm.store import scratch, small_batches, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _lean(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage with small batches of texts, which stay set in the session as its result is written later."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


@_lean
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the toxicity threshold stay, all columns as they are."""
    model = toxicity.fit(docs, _labels(spark, sf_dir))
    return toxicity.score(docs, model).where("predicted = 0").select("row.*").select(*COLUMNS)


@_lean
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its text loses lines that an earlier document has, and n_chars follows the text."""
    found = line_dedup.dedup_lines(docs)
    text = F.when((F.col("n_dropped") == 0) & F.col("row.text").isNull(), F.lit(None)).otherwise(F.col("kept"))
    n_chars = F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(F.length("kept").cast("bigint"))
    return found.select("row.doc_id", text.alias("text"), "row.lang", "row.source", n_chars.alias("n_chars"))


@_lean
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the rows of the smallest id stay.

    Near copies have fingerprints of five-word shingles that are two bits apart at most, or
    similarity 0.8 of these shingles. Wordless texts, what line dedup leaves of exact copies among them, are one
    group. Repeated rows of one id stay together, and so do rows without an id.
    """
    gone = jaccard.near_copies(docs).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


#: Weights in tokens of the mix.
TARGETS = {"good": 0.9, "poor": 0.095, "toxic": 0.005}


@_lean
def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go into the mix by their rates: poor and toxic ones may drop out or repeat, good ones stay and may repeat.

    The mix has as many tokens as come in, or as many more as it takes to keep every good document.
    """
    return mixing.repeated(mixing.mix(docs, _labels(spark, sf_dir), TARGETS, keep="good")).select(*COLUMNS)


@_lean
def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_split, ids of each row: encoded, and decoded again."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("mixing to target weights", mix_to_targets),
    ("byte-level BPE", tokenise),
]

#: Scores, fingerprints and fitted rates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; a stage's own tables are deleted once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
