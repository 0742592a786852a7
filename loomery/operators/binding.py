"""Rule binding: records against rules, one verdict for each rule that applies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loomery.config import Project, Rule
from loomery.functions.scalars import joined, rounded
from loomery.operators.eligibility import located

ASSERTION_FIELDS = "rule_id:string,category:string,verdict:string,score:double,rationale:string,faction:string,faction_context:string"


def rule_table(spark, project: Project) -> DataFrame:
    """One row a rule; the number of rules is fixed by configuration, so the table may be broadcast."""
    modes = {r.id: [m for m, ids in project.rubric.failure_to_rules.items() if r.id in ids] for r in project.rules}
    rows = [(i, r.id, r.category, list(r.dims), list(r.lanes) if r.lanes else None, r.group_specific, r.desc, r.rationale_pass, r.rationale_fail, modes[r.id]) for i, r in enumerate(project.rules)]
    return spark.createDataFrame(
        rows, "ord int, rule_id string, category string, dims array<string>, lanes array<string>, group_specific boolean, about string, rationale_pass string, rationale_fail string, modes array<string>"
    )


def verdict(status: Column, score: Column, failed_by_mode: Column, thresholds: dict[str, tuple[float, float]]) -> Column:
    """By the thresholds of the status; any other status counts as approved."""

    def ladder(name: str) -> Column:
        high, low = thresholds[name]
        return F.when(score >= high, "pass").when(score >= low, "partial").otherwise("fail")

    return F.when(status == "rejected", F.when(failed_by_mode, "fail").otherwise(ladder("rejected"))).when(status == "borderline", ladder("borderline")).otherwise(ladder("approved"))


def _lookup(group: Column, values: dict[str, str | None]) -> Column:
    out = F.lit(None).cast("string")
    for name, value in values.items():
        if value:
            out = F.when(group == name, value).otherwise(out)
    return out


def _rationale(project: Project, group: Column, given: dict[str, Column]) -> Column:
    """Template of the rule with its values; ``given`` has mean, verdict, rule_id, about, rationale_pass and rationale_fail."""
    percent = rounded(given["mean"] * 100).cast("string")
    template = F.when(given["verdict"] == "pass", given["rationale_pass"]).otherwise(given["rationale_fail"])
    for name, key, default in (("groupMaterial", "material", "faction material"), ("groupShapes", "shapes", "faction shapes"), ("groupWear", "wear", "faction-correct aging")):
        value = F.coalesce(_lookup(group, {g.name: getattr(g, key) for g in project.terminology.groups}), F.lit(default))
        template = F.replace(template, F.lit("${" + name + "}"), value)
    template = F.replace(template, F.lit("${scorePct}"), percent)
    plain = F.concat(F.when(given["verdict"] == "pass", "Passes ").otherwise("Fails "), given["rule_id"], F.lit(" ("), percent, F.lit("%)"))
    partly = F.concat(F.lit("Partially meets "), F.lower(given["about"]), F.lit(" ("), percent, F.lit("%)"))
    return F.when(given["verdict"] == "partial", partly).otherwise(F.coalesce(F.nullif(template, F.lit("")), plain))


def _context(project: Project, group: Column, rule: Column) -> Column:
    """Override by rule, then the group's own words for the rule, then one of three fallbacks by rule id."""
    terms = project.terminology
    out = F.lit(None).cast("string")
    for rule_id, key in (("MAT-001", "material"), ("MAT-002", "wear"), ("SHP-001", "shapes")):
        out = F.when(rule == rule_id, _lookup(group, {g.name: getattr(g, key) for g in terms.groups})).otherwise(out)
    for g in terms.groups:
        for rule_id, text in g.construction.items():
            out = F.when((group == g.name) & (rule == rule_id), text).otherwise(out)
    for rule_id, text in terms.context.items():
        out = F.when(rule == rule_id, text).otherwise(out)
    return out


def assertions(records: DataFrame, project: Project, force: bool = True) -> DataFrame:
    """One row for each record and rule that applies: id, lane, grp, status, ord, rule_id, category, verdict, score, mean, rationale, faction, faction_context.

    Records without scores have none; bound ones are skipped unless ``force``.
    The rules side is a broadcast of fixed size, so the theta-join streams over records without a shuffle.
    """
    todo = records.where(F.col("judgment.criteria_scores").isNotNull())
    if not force:
        todo = todo.where(F.coalesce(F.size("canon.assertions"), F.lit(0)) == 0)
    judged = located(todo, project).select("id", "lane", "grp", F.col("judgment.status").alias("status"), F.col("judgment.criteria_scores").alias("scores"), F.coalesce("judgment.failure_modes", F.array().cast("array<string>")).alias("failed"))
    rules = F.broadcast(rule_table(records.sparkSession, project))
    applies = (~F.col("group_specific") | F.col("grp").isNotNull()) & (F.col("lanes").isNull() | F.array_contains("lanes", F.col("lane")))
    values = F.filter(F.transform("dims", lambda d: F.try_element_at("scores", d)), lambda s: s.isNotNull())
    paired = judged.join(rules, applies).withColumn("values", values).where(F.size("values") > 0)
    scored = paired.withColumn("mean", F.aggregate("values", F.lit(0.0), lambda a, s: a + s) / F.size("values"))
    ruled = scored.withColumn("verdict", verdict(F.col("status"), F.col("mean"), F.arrays_overlap("failed", "modes"), project.rubric.thresholds))
    group = F.when(F.col("group_specific"), F.col("grp"))
    return ruled.select(
        "id", "lane", "grp", "status", "ord", "rule_id", "category", "verdict", (rounded(F.col("mean") * 100) / 100).alias("score"), "mean",
        _rationale(project, F.col("grp"), {c: F.col(c) for c in ("mean", "verdict", "rule_id", "about", "rationale_pass", "rationale_fail")}).alias("rationale"), group.alias("faction"),
        F.when(group.isNotNull(), _context(project, F.col("grp"), F.col("rule_id"))).alias("faction_context"),
    )


def canon_blocks(asserted: DataFrame) -> DataFrame:
    """One row a bound record: id, grp, status, assertions in rule order and their counts. A record has at most one per rule."""
    fields = F.struct("ord", "rule_id", "category", "verdict", "score", "rationale", "faction", "faction_context")
    grouped = asserted.groupBy("id").agg(F.first("grp").alias("grp"), F.first("status").alias("status"), F.array_sort(F.collect_list(fields)).alias("sorted"), F.count("*").cast("int").alias("assertion_count"), *(F.count_if(F.col("verdict") == v).cast("int").alias(f"{v}_count") for v in ("pass", "fail", "partial")))
    return grouped.withColumn("assertions", F.transform("sorted", lambda a: a.dropFields("ord"))).drop("sorted")


def explanation(block: DataFrame, text: Column) -> Column:
    """The sentence that goes with a bound record, by its status."""
    said = F.coalesce(text, F.lit(""))
    failed = joined(F.filter("assertions", lambda a: a["verdict"] == "fail")["rule_id"])
    group = F.when(F.col("grp").isNotNull(), F.concat(F.lit("Faction: "), F.col("grp"), F.lit("."))).otherwise("")
    counts = [F.col(c).cast("string") for c in ("pass_count", "fail_count", "assertion_count")]
    approved = F.concat(F.lit("Approved: passes "), counts[0], F.lit("/"), counts[2], F.lit(" constitution rules. "), group, F.lit(" "), said)
    rejected = F.concat(F.lit("Rejected: fails "), failed, F.lit(". "), said)
    other = F.concat(F.lit("Borderline: "), counts[0], F.lit(" pass, "), counts[1], F.lit(" fail out of "), counts[2], F.lit(" rules. "), said)
    return F.trim(F.when(F.col("status") == "approved", approved).when(F.col("status") == "rejected", rejected).otherwise(other))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def assertion_array(project: Project) -> Column:
    """The assertions of a located record in rule order, as one expression: a rule that doesn't apply gives none."""
    scores, status, group = F.col("judgment.criteria_scores"), F.col("judgment.status"), F.col("grp")
    failed = F.coalesce("judgment.failure_modes", F.array().cast("array<string>"))
    modes = {r.id: [m for m, ids in project.rubric.failure_to_rules.items() if r.id in ids] for r in project.rules}

    def one(rule: Rule) -> Column:
        values = F.filter(F.array(*(F.try_element_at(scores, F.lit(d)) for d in rule.dims)), lambda s: s.isNotNull())
        hit = F.arrays_overlap(failed, F.array(*map(F.lit, modes[rule.id]))) if modes[rule.id] else F.lit(False)
        given = {"rule_id": F.lit(rule.id), "about": F.lit(rule.desc), "rationale_pass": F.lit(rule.rationale_pass).cast("string"), "rationale_fail": F.lit(rule.rationale_fail).cast("string")}

        def made(mean: Column, word: Column) -> Column:
            return F.struct(
                F.lit(rule.id).alias("rule_id"), F.lit(rule.category).alias("category"), word.alias("verdict"), (rounded(mean * 100) / 100).alias("score"), _rationale(project, group, given | {"mean": mean, "verdict": word}).alias("rationale"),
                (group if rule.group_specific else F.lit(None).cast("string")).alias("faction"), (_context(project, group, F.lit(rule.id)) if rule.group_specific else F.lit(None).cast("string")).alias("faction_context"),
            )

        scored = _let(F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values), lambda mean: _let(verdict(status, mean, hit, project.rubric.thresholds), lambda word: made(mean, word)))
        applies = scores.isNotNull() & (F.size(values) > 0)
        if rule.group_specific:
            applies = applies & group.isNotNull()
        if rule.lanes:
            applies = applies & F.col("lane").isin(*rule.lanes)
        return F.when(applies, scored)

    if not any(r.dims for r in project.rules):
        return F.array().cast(f"array<struct<{ASSERTION_FIELDS}>>")
    return F.filter(F.array(*(one(r) for r in project.rules if r.dims)), lambda x: x.isNotNull())


def bind(records: DataFrame, project: Project, force: bool = False, bound_by: str = "loomery-bind", bound_at: str | None = None) -> DataFrame:
    """Records with their canon block replaced where rules applied; all others as they are. One projection, no shuffle."""
    todo = F.lit(True) if force else F.coalesce(F.size("canon.assertions"), F.lit(0)) == 0
    kind = records.schema["canon"].dataType
    # a generator of one row computes the assertions once; as a plain column they would be copied into every use
    found = located(records, project).select("*", F.explode(F.array(F.when(todo, assertion_array(project)))).alias("_found"))
    count = lambda word: F.size(F.filter("_found", lambda a: a["verdict"] == word)).alias(f"{word}_count")
    made = F.struct(
        F.lit(project.constitution_version).alias("constitution_version"), F.lit(bound_at).cast("string").alias("bound_at"), F.lit(bound_by).alias("bound_by"), F.col("grp").alias("faction"),
        F.col("_found").alias("assertions"), F.size("_found").alias("assertion_count"), count("pass"), count("fail"), count("partial"), F.col("canon.forbidden_inputs").alias("forbidden_inputs"),
    )
    return found.withColumn("canon", F.when(F.size("_found") > 0, made.cast(kind)).otherwise(F.col("canon"))).select(*records.columns)


def binding_stats(asserted: DataFrame) -> DataFrame:
    """(kind, name, n): records per group, then assertions per verdict."""
    groups = asserted.select("id", F.coalesce("grp", F.lit("unknown")).alias("name")).distinct().groupBy("name").agg(F.count("*").alias("n"))
    verdicts = asserted.groupBy(F.col("verdict").alias("name")).agg(F.count("*").alias("n"))
    return groups.select(F.lit("group").alias("kind"), "name", "n").unionByName(verdicts.select(F.lit("verdict").alias("kind"), "name", "n"))
