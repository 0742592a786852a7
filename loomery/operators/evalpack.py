"""Evaluation packs: four task relations over judged and bound records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomery.functions.scalars import ratio, truthy


def _approved(located: DataFrame) -> DataFrame:
    return located.where((F.col("judgment.status") == "approved") & (F.coalesce(F.size("canon.assertions"), F.lit(0)) > 0))


def _file_order() -> Column:
    """Ties go by file name, whose suffix takes part in the order."""
    return F.concat("id", F.lit(".json"))


def _best(located: DataFrame, by: Column, most: int) -> DataFrame:
    share = F.coalesce(F.try_divide(F.col("canon.pass_count").cast("double"), F.col("canon.assertion_count").cast("double")), F.lit(0.0))
    keyed = _approved(located).withColumn("_by", by).withColumn("_share", share)
    rank = F.row_number().over(Window.partitionBy("_by").orderBy(F.col("_share").desc(), _file_order()))
    return keyed.withColumn("_rank", rank).where(F.col("_rank") <= most)


def _pass_ratio() -> Column:
    return ratio(F.col("canon.pass_count"), F.col("canon.assertion_count"), 0.0).alias("pass_ratio")


def lane_coverage(located: DataFrame, most: int = 5) -> DataFrame:
    """Best approved records of each lane."""
    return _best(located, F.col("lane"), most).select(F.lit("lane_coverage").alias("task"), F.col("id").alias("record_id"), "lane", _pass_ratio(), "asset_path")


def anchor_gold(located: DataFrame, most: int = 3) -> DataFrame:
    """Best approved records of each faction."""
    faction = F.coalesce("grp", F.lit("unknown"))
    picked = _best(located, faction, most)
    return picked.select(F.lit("anchor_gold").alias("task"), F.col("id").alias("record_id"), faction.alias("faction"), _pass_ratio(), F.col("canon.assertion_count").alias("assertion_count"), "asset_path")


def _violations() -> Column:
    none = F.array().cast("array<string>")
    failed = F.coalesce(F.filter("canon.assertions", lambda a: a["verdict"] == "fail")["rule_id"], none)
    return F.array_union(F.coalesce("judgment.failure_modes", none), failed)


def _shows_drift() -> Column:
    return (F.size(_violations()) > 0) | truthy(F.col("judgment.explanation")).isNotNull()


def forbidden_drift(located: DataFrame, most: int = 20) -> DataFrame:
    """Rejected and borderline records with violations or an explanation, most violations first."""
    pool = located.where(F.col("judgment.status").isin("rejected", "borderline") & _shows_drift())
    pool = pool.withColumn("violations", _violations()).withColumn("said", truthy(F.col("judgment.explanation")))
    return pool.orderBy(F.size("violations").desc(), _file_order()).limit(most).select(F.lit("forbidden_drift").alias("task"), F.col("id").alias("record_id"), F.col("judgment.status").alias("status"), "violations", F.col("said").alias("explanation"), "asset_path")


def subject_continuity(located: DataFrame, most: int = 10) -> DataFrame:
    """Subjects with the most records; the first record by file name gives type and faction."""
    named = located.where(truthy(F.col("identity.subject_name")).isNotNull())
    first = F.min(F.struct(_file_order().alias("at"), F.col("identity.subject_type").alias("kind"), F.col("identity.faction").alias("faction")))
    counted = named.groupBy(F.col("identity.subject_name").alias("subject_name")).agg(F.count("*").alias("record_count"), first.alias("first"))
    top = counted.orderBy(F.col("record_count").desc(), F.col("first.at")).limit(most)
    # ids are gathered for the few chosen subjects only
    ids = named.select(F.col("identity.subject_name").alias("subject_name"), "id").join(F.broadcast(top.select("subject_name")), "subject_name")
    ids = ids.groupBy("subject_name").agg(F.sort_array(F.collect_list("id")).alias("record_ids"))
    return top.join(ids, "subject_name").select(
        F.lit("subject_continuity").alias("task"), "subject_name", "record_count", "record_ids", F.coalesce(truthy(F.col("first.kind")), F.lit("unknown")).alias("subject_type"), F.col("first.faction").alias("faction")
    )


def pool_sizes(located: DataFrame, **sampled: DataFrame) -> DataFrame:
    """(task, available): what each task could have drawn from; with the tasks' relations by name also sampled, what they have drawn."""
    ok = (F.col("judgment.status") == "approved") & (F.coalesce(F.size("canon.assertions"), F.lit(0)) > 0)
    drift = F.col("judgment.status").isin("rejected", "borderline") & _shows_drift()
    row = located.agg(F.count_if(ok).alias("lane_coverage"), F.count_if(ok).alias("anchor_gold"), F.count_if(drift).alias("forbidden_drift"), F.count_distinct(truthy(F.col("identity.subject_name"))).alias("subject_continuity"))
    names = ", ".join(f"'{n}', {n}" for n in row.columns)
    sizes = row.selectExpr(f"stack({len(row.columns)}, {names}) as (task, available)")
    if not sampled:
        return sizes
    drawn = None
    for task, rows in sampled.items():
        one = rows.agg(F.count("*").alias("sampled")).select(F.lit(task).alias("task"), "sampled")
        drawn = one if drawn is None else drawn.unionByName(one)
    return sizes.join(drawn, "task", "left").select("task", "available", F.coalesce("sampled", F.lit(0)).alias("sampled"))
