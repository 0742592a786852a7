"""Which records qualify, with every reason why one doesn't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loomery.config import Project, SelectionProfile
from loomery.functions.detect import group_of, lane_of
from loomery.functions.scalars import compact, either, joined

#: Reason codes in the order of the checks; also the exclusion categories.
CODES = ("no_judgment", "wrong_status", "not_canon_bound", "low_pass_ratio", "excluded_lane", "rights_filter", "excluded_tags")


def located(records: DataFrame, project: Project) -> DataFrame:
    """Adds lane and grp, computed once for everything after."""
    prompt = F.coalesce(F.col("provenance.prompt"), F.lit(""))
    return records.withColumns({"lane": lane_of(F.col("id"), project.lanes), "grp": group_of(F.col("id"), prompt, project.terminology)})


def _bound(column: str = "canon.assertions") -> Column:
    return F.coalesce(F.size(column), F.lit(0)) > 0


def failures(profile: SelectionProfile) -> list[tuple[str, Column, Column]]:
    """(code, condition, message) of each check that the profile asks for, in order. Needs ``lane``."""
    status, judged = F.col("judgment.status"), F.col("judgment").isNotNull()
    out: list[tuple[str, Column, Column]] = []
    if profile.require_judgment:
        out.append((CODES[0], ~judged, F.lit("no judgment (record has not been reviewed)")))
    if profile.require_status:
        wanted = ", ".join(profile.require_status)
        bad = judged & ~F.coalesce(status.isin(*profile.require_status), F.lit(False))
        out.append((CODES[1], bad, F.concat(F.lit('status "'), F.coalesce(status, F.lit("undefined")), F.lit(f'" not in [{wanted}]'))))
    if profile.require_canon_bound:
        out.append((CODES[2], ~_bound(), F.lit("not canon-bound (no assertions)")))
    if profile.minimum_pass_ratio is not None:
        share = F.try_divide(F.col("canon.pass_count").cast("double"), F.col("canon.assertion_count").cast("double"))
        low = (F.coalesce(F.col("canon.assertion_count"), F.lit(0)) > 0) & (share < profile.minimum_pass_ratio)
        message = F.format_string(f"pass ratio %d%% below minimum {round(profile.minimum_pass_ratio * 100)}%%", F.floor(share * 100 + 0.5))
        out.append((CODES[3], low, message))
    if profile.exclude_lanes:
        out.append((CODES[4], F.col("lane").isin(*profile.exclude_lanes), F.concat(F.lit('lane "'), F.col("lane"), F.lit('" is excluded'))))
    if profile.rights_filter is not None:
        rights = either(F.col("rights_status"), F.col("training_rights_status"))
        message = F.concat(F.lit('rights "'), F.coalesce(rights, F.lit("unknown")), F.lit(f'" does not match required "{profile.rights_filter}"'))
        out.append((CODES[5], ~rights.eqNullSafe(F.lit(profile.rights_filter)), message))
    if profile.exclude_tags:
        tags = F.filter("dataset_tags", lambda t: t.isin(*profile.exclude_tags))
        out.append((CODES[6], F.coalesce(F.size(tags), F.lit(0)) > 0, F.concat(F.lit("has excluded tags: "), joined(tags))))
    return out


def evaluate(records: DataFrame, project: Project, profile: SelectionProfile) -> DataFrame:
    """Adds lane, grp, reasons (array of code and message) and eligible; one projection, no shuffle."""
    checks = [F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(code).alias("code"), text.alias("message"))) for code, bad, text in failures(profile)]
    reasons = compact(*checks) if checks else F.array().cast("array<struct<code:string,message:string>>")
    return located(records, project).withColumn("reasons", reasons).withColumn("eligible", F.size("reasons") == 0)


def exclusion_counts(evaluated: DataFrame) -> DataFrame:
    """(code, n): one per reason, all categories present."""
    found = evaluated.select(F.explode("reasons.code").alias("code")).groupBy("code").agg(F.count("*").alias("n"))
    every = evaluated.sparkSession.createDataFrame([(c,) for c in CODES], "code string")
    return every.join(found, "code", "left").select("code", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def near_misses(evaluated: DataFrame, top: int = 5) -> DataFrame:
    """Most frequent reasons among records that only one reason keeps out."""
    one = evaluated.where(F.size("reasons") == 1).groupBy(F.col("reasons")[0]["message"].alias("reason")).agg(F.count("*").alias("n"))
    return one.orderBy(F.col("n").desc(), "reason").limit(top)


def eligibility_rate(evaluated: DataFrame) -> DataFrame:
    total, ok = F.count("*"), F.count_if("eligible")
    return evaluated.agg(total.alias("total"), ok.alias("eligible"), F.round(F.try_divide(ok * 100.0, total.cast("double")), 1).alias("rate_pct"))
