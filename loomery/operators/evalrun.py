"""Scoring of outputs against an evaluation pack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SAMPLES = 5


def last_outputs(outputs: DataFrame, position: Column) -> DataFrame:
    """(record_id, accept): the last row of an id by position wins."""
    return outputs.groupBy("record_id").agg(F.max_by("accept", position).alias("accept")).select("record_id", F.coalesce("accept", F.lit(False)).alias("accept"))


def _score(good: Column, total: Column, empty: float) -> Column:
    return F.coalesce(F.try_divide(good.cast("double"), total.cast("double")), F.lit(empty))


def _card(task: str, hits: DataFrame, good: str, key: str, order: str, empty: float, least: float) -> DataFrame:
    """hits: one row a task with ``ok``; misses give the first few samples by order."""
    total, right = F.count("*"), F.count_if("ok")
    row = hits.agg(total.alias("total"), right.alias("good"), _score(right, total, empty).alias("raw"))
    missed = hits.where("not ok").orderBy(order).limit(SAMPLES).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(key).alias("k"))))["k"].alias("samples"))
    # two rows of one record each, side by side
    both = row.withColumn("_one", F.lit(1)).join(missed.withColumn("_one", F.lit(1)), "_one")
    return both.select(F.lit(task).alias("task"), "total", "good", F.round("raw", 3).alias("score"), (F.col("raw") >= least).alias("passed"), F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))


def _hits(tasks: DataFrame, outputs: DataFrame, wanted: bool) -> DataFrame:
    accepted = F.coalesce("accept", F.lit(False))
    return tasks.join(outputs, "record_id", "left").withColumn("ok", accepted if wanted else ~accepted)


def lane_coverage(tasks: DataFrame, outputs: DataFrame) -> DataFrame:
    return _card("lane_coverage", _hits(tasks, outputs, True), "covered", "record_id", "record_id", 0.0, 0.7)


def forbidden_drift(tasks: DataFrame, outputs: DataFrame) -> DataFrame:
    """Passed only without any false acceptance."""
    return _card("forbidden_drift", _hits(tasks, outputs, False), "rejected", "record_id", "record_id", 1.0, 1.0)


def anchor_gold(tasks: DataFrame, outputs: DataFrame) -> DataFrame:
    return _card("anchor_gold", _hits(tasks, outputs, True), "matched", "record_id", "record_id", 0.0, 0.8)


def subject_continuity(tasks: DataFrame, outputs: DataFrame) -> DataFrame:
    """A subject is covered with two accepted records or more."""
    each = tasks.select("subject_name", F.explode_outer("record_ids").alias("record_id")).join(outputs, "record_id", "left")
    hits = each.groupBy("subject_name").agg((F.count_if(F.coalesce("accept", F.lit(False))) >= 2).alias("ok"))
    return _card("subject_continuity", hits, "covered", "subject_name", "subject_name", 0.0, 0.6)


def overall(cards: DataFrame) -> DataFrame:
    """(passed, score): all passed, mean of the tasks' scores; no tasks pass with 0."""
    mean = F.coalesce(F.round(F.avg("score"), 3), F.lit(0.0))
    return cards.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"), mean.alias("score"), F.count("*").alias("tasks"))
