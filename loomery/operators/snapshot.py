"""Snapshots: a frozen selection, its distributions, and the difference of two."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomery.config import SelectionProfile


def rules_checked(profile: SelectionProfile) -> list[str]:
    asked = (
        ("require_judgment", profile.require_judgment), ("require_status", profile.require_status), ("require_canon_bound", profile.require_canon_bound), ("minimum_pass_ratio", profile.minimum_pass_ratio is not None),
        ("exclude_lanes", profile.exclude_lanes), ("rights_filter", profile.rights_filter is not None), ("exclude_tags", profile.exclude_tags),
    )
    return [name for name, on in asked if on]


def pass_ratio_text() -> Column:
    some = F.coalesce(F.col("canon.assertion_count"), F.lit(0)) > 0
    return F.when(some, F.concat_ws("/", F.col("canon.pass_count").cast("string"), F.col("canon.assertion_count").cast("string"))).otherwise("n/a")


def included(evaluated: DataFrame, profile: SelectionProfile, config_fingerprint: str) -> DataFrame:
    """record_id, reason, rules_checked, profile_id, config_fingerprint of eligible records. An unjudged one has status null."""
    status = F.coalesce(F.col("judgment.status"), F.lit("null"))
    reason = F.concat(status, F.lit(", canon-bound, pass_ratio="), pass_ratio_text(), F.lit(", lane="), F.col("lane"))
    return evaluated.where("eligible").select(
        F.col("id").alias("record_id"), reason.alias("reason"), F.array(*map(F.lit, rules_checked(profile))).cast("array<string>").alias("rules_checked"), F.lit(profile.profile_id).alias("profile_id"), F.lit(config_fingerprint).alias("config_fingerprint")
    )


def excluded(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(~F.col("eligible")).select(F.col("id").alias("record_id"), F.col("reasons.message").alias("reasons"))


def distributions(evaluated: DataFrame) -> DataFrame:
    """(kind, name, n) over eligible records: lane, faction ('unknown' for none), verdict (pass, fail and partial always there)."""
    ok = evaluated.where("eligible")
    # one pass over the records: each gives its lane, its faction and its verdicts
    named = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("name"))
    verdicts = F.coalesce(F.transform("canon.assertions", lambda a: named("verdict", a["verdict"])), F.array().cast("array<struct<kind:string,name:string>>"))
    each = ok.select(F.inline(F.concat(F.array(named("lane", F.col("lane")), named("faction", F.coalesce("grp", F.lit("unknown")))), verdicts))).withColumn("one", F.lit(1))
    zeros = evaluated.sparkSession.createDataFrame([("verdict", v, 0) for v in ("pass", "fail", "partial")], "kind string, name string, one int")
    return each.unionByName(zeros).groupBy("kind", "name").agg(F.sum("one").cast("bigint").alias("n"))


def verdict_counts(elements: DataFrame, verdict: Column, record: Column) -> DataFrame:
    """(verdict, n, records): elements of each verdict, and the records they are of."""
    return elements.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"), F.count_distinct(record).alias("records"))


def marked_difference(marked: DataFrame, key: str = "record_id") -> DataFrame:
    """The difference of two selections of one table, whose rows are marked ``before`` and ``after``; ids in neither fall out."""
    sides = marked.groupBy(key).agg(F.max("before").alias("before"), F.max("after").alias("after")).where(F.col("before") | F.col("after"))
    return sides.select(key, F.when(~F.col("after"), "removed").when(~F.col("before"), "added").otherwise("shared").alias("change"))


def difference(before: DataFrame, after: DataFrame, key: str = "record_id") -> DataFrame:
    """(record_id, change): removed, added or shared, each id once."""
    a = before.select(key).distinct().withColumn("_a", F.lit(True))
    b = after.select(key).distinct().withColumn("_b", F.lit(True))
    change = F.when(F.col("_b").isNull(), "removed").when(F.col("_a").isNull(), "added").otherwise("shared")
    return a.join(b, key, "full").select(key, change.alias("change"))


def capped(evaluated: DataFrame, profile: SelectionProfile) -> DataFrame:
    """Extension: applies max_per_lane and max_per_subject to eligible records, smallest file names first."""
    out = evaluated.where("eligible").withColumn("_subject", F.coalesce("identity.subject_name", "id"))
    for most, by in ((profile.max_per_lane, "lane"), (profile.max_per_subject, "_subject")):
        if most is not None:
            rank = F.row_number().over(Window.partitionBy(by).orderBy(F.concat("id", F.lit(".json"))))
            out = out.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")
    return out.drop("_subject")
