"""Records derived from the standard tables, in Spark and in SQL, and the project they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomery.config import Group, Lane, Lanes, Project, Rubric, Rule, SelectionProfile, SplitProfile, Terminology, TrainingProfile

LANES = Lanes(
    (Lane("hull", ("^doc_[0-9]*[05]_", "^ship_")), Lane("hall", ("^doc_[0-9]*[27]_v[12]$",)), Lane("tool", ("^doc_[0-9]*[49]_", "_v9$")), Lane("empty")),
    "costume",
)
TERMS = Terminology(
    groups=(
        Group("north", ("_doc_north", "^doc_[0-9]*11_"), ("lang en",), "riveted steel", "square shapes", "salt wear", {"SIL-001": "northern outline"}),
        Group("south", ("^doc_[0-9]*22_",), ("lang (fr|es)",), "woven reed", "round shapes", None),
        Group("v1", (), ()),
    ),
    cross_group=(("^doc_[0-9]*33_", "detect_from_id_suffix"), ("^doc_[0-9]*44_", "none")),
    edge_defaults=(("^doc_[0-9]*55_", "south"),),
    null_patterns=("^doc_[0-9]*[02468]6_",),
    id_fallbacks=(("_v3$", "north"),),
    context={"PAL-001": "house palette"},
)
RULES = (
    Rule("SIL-001", "silhouette", ("clarity",), None, True, "Outline reads at once", "Outline holds at ${scorePct}%: ${groupShapes}", "Outline fails at ${scorePct}%"),
    Rule("MAT-001", "material", ("balance", "detail"), None, True, "Materials fit the group", "Uses ${groupMaterial} with ${groupWear} (${scorePct}%)", None),
    Rule("PAL-001", "palette", ("balance",), None, False, "Palette Stays In Range", None, "Off palette (${scorePct}%)"),
    Rule("SHP-001", "shape", ("clarity", "balance", "detail"), ("hull", "costume"), False, "Shapes agree", None, None),
    Rule("DET-001", "detail", ("detail",), ("tool", "hall"), False, "Detail is useful", "Detail at ${scorePct}%", "Too little detail"),
    Rule("NIL-001", "none", ("absent",), None, False, "Never scored"),
)
PROJECT = Project(LANES, TERMS, RULES, Rubric(("clarity", "balance", "detail"), failure_to_rules={"too_busy": ("DET-001", "SHP-001"), "off_palette": ("PAL-001",)}), "2.1.0")
STRICT = SelectionProfile("strict", exclude_lanes=("tool",), rights_filter="cleared", exclude_tags=("wip", "draft"))
LOOSE = SelectionProfile("loose", require_status=("approved", "borderline"), require_canon_bound=False, minimum_pass_ratio=None)
SPLIT = SplitProfile("seven", 0.7, 0.15, 0.15, 7)
TRAINING = TrainingProfile("house-style-lora", eligible_lanes=("hull", "costume"), prompt_strategy="trigger-word")


def record_id(n) -> F.Column:
    return F.concat(F.lit("doc_"), n.cast("string"), F.lit("_v"), (n % 3 + 1).cast("string"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without canon blocks: documents with labels where there are any."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    d, n = F.col("doc_id"), F.col("n_chars")
    score = lambda x: (x % 100) / F.lit(100.0)
    entries = [(F.lit("clarity"), score(n)), (F.lit("balance"), score(d * 37))]
    scores = F.map_from_arrays(F.array(*(k for k, _ in entries)), F.array(*(v for _, v in entries)))
    scores = F.when(d % 11 == 0, scores).otherwise(F.map_concat(scores, F.map_from_arrays(F.array(F.lit("detail")), F.array(score(d * 53 + n)))))
    status = F.when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 1, "approved").otherwise("borderline")
    modes = F.when(F.col("toxic") == 1, F.when(n % 2 == 0, F.array(F.lit("too_busy"))).otherwise(F.array(F.lit("off_palette"), F.lit("too_busy")))).otherwise(F.array().cast("array<string>"))
    said = F.when(d % 6 == 0, F.concat(F.lit("seen in "), F.col("source"))).when(d % 6 == 1, "")
    parent = F.when(d % 50 == 10, record_id(d + 1)).when(d % 5 == 1, record_id(d - 1)).when(d % 5 == 2, record_id(d - 1)).when(d % 5 == 3, record_id(d - 1))
    joined = docs.join(labels, "doc_id", "left")
    none = lambda kind: F.lit(None).cast(kind)
    return joined.select(
        record_id(d).alias("id"), F.when(d % 17 != 3, F.concat(F.lit("images/"), record_id(d), F.lit(".png"))).alias("asset_path"),
        F.struct(F.concat(F.lit("a scene, lang "), F.col("lang"), F.lit(", "), F.coalesce("text", F.lit(""))).alias("prompt"), (d * 7 % 1000).alias("seed")).alias("provenance"),
        F.when(F.col("toxic").isNotNull(), F.struct(status.alias("status"), said.alias("explanation"), scores.alias("criteria_scores"), modes.alias("failure_modes"))).alias("judgment"),
        F.struct(F.when(d % 4 == 0, F.concat(F.lit("subject_"), (d % 97).cast("string"))).alias("subject_name"), F.when(d % 8 == 0, F.lit("person")).alias("subject_type"), F.col("lang").alias("faction"), none("string").alias("kind")).alias("identity"),
        F.struct(parent.alias("derived_from_record_id")).alias("lineage"),
        F.when(d % 7 == 0, "restricted").when(d % 7 == 1, "").otherwise("cleared").alias("rights_status"), F.when(d % 7 == 1, "cleared").alias("training_rights_status"),
        F.when(d % 13 == 0, F.array(F.lit("wip"))).when(d % 13 == 1, F.array(F.lit("ok"), F.lit("draft"), F.lit("wip"))).when(d % 13 == 2, F.array(F.lit("ok"))).alias("dataset_tags"),
    )


def with_empty_canon(base: DataFrame) -> DataFrame:
    kind = "struct<constitution_version:string,bound_at:string,bound_by:string,faction:string,assertions:array<struct<rule_id:string,category:string,verdict:string,score:double,rationale:string,faction:string,faction_context:string>>,assertion_count:int,pass_count:int,fail_count:int,partial_count:int,forbidden_inputs:array<string>>"
    return base.withColumn("canon", F.lit(None).cast(kind))


# ---- the same in SQL -------------------------------------------------------------------

RECORDS_SQL = """
rec as (
  select d.doc_id as n, 'doc_'||d.doc_id||'_v'||(d.doc_id % 3 + 1) as id,
    case when d.doc_id % 17 <> 3 then 'images/doc_'||d.doc_id||'_v'||(d.doc_id % 3 + 1)||'.png' end as asset_path,
    'a scene, lang '||d.lang||', '||coalesce(d.text, '') as prompt,
    case when l.toxic is null then null when l.toxic = 1 then 'rejected' when l.quality = 1 then 'approved' else 'borderline' end as status,
    case when d.doc_id % 6 = 0 then 'seen in '||d.source when d.doc_id % 6 = 1 then '' end as said,
    (d.n_chars % 100) / 100.0::double as clarity, (d.doc_id * 37 % 100) / 100.0::double as balance,
    case when d.doc_id % 11 <> 0 then ((d.doc_id * 53 + d.n_chars) % 100) / 100.0::double end as detail,
    case when l.toxic = 1 then case when d.n_chars % 2 = 0 then ['too_busy'] else ['off_palette', 'too_busy'] end else []::varchar[] end as modes,
    case when d.doc_id % 4 = 0 then 'subject_'||(d.doc_id % 97) end as subject, case when d.doc_id % 8 = 0 then 'person' end as subject_type, d.lang as faction,
    case when d.doc_id % 50 = 10 then 'doc_'||(d.doc_id+1)||'_v'||((d.doc_id+1) % 3 + 1) when d.doc_id % 5 in (1, 2, 3) then 'doc_'||(d.doc_id-1)||'_v'||((d.doc_id-1) % 3 + 1) end as parent,
    case when d.doc_id % 7 = 0 then 'restricted' when d.doc_id % 7 = 1 then 'cleared' else 'cleared' end as rights,
    case when d.doc_id % 13 = 0 then ['wip'] when d.doc_id % 13 = 1 then ['ok', 'draft', 'wip'] when d.doc_id % 13 = 2 then ['ok'] end as tags
  from documents d left join labels l using (doc_id)
), loc as (
  select *,
    case when regexp_matches(lower(id), '^doc_[0-9]*[05]_|^ship_') then 'hull' when regexp_matches(lower(id), '^doc_[0-9]*[27]_v[12]$') then 'hall'
      when regexp_matches(lower(id), '^doc_[0-9]*[49]_|_v9$') then 'tool' else 'costume' end as lane,
    case when regexp_matches(id, '_doc_north|^doc_[0-9]*11_') then 'north' when regexp_matches(id, '^doc_[0-9]*22_') then 'south'
      when regexp_matches(id, '^doc_[0-9]*33_') then case when contains(id, 'north') then 'north' when contains(id, 'south') then 'south' when contains(id, 'v1') then 'v1' end
      when regexp_matches(id, '^doc_[0-9]*44_') then null when regexp_matches(id, '^doc_[0-9]*55_') then 'south'
      when regexp_matches(lower(prompt), 'lang en') then 'north' when regexp_matches(lower(prompt), 'lang (fr|es)') then 'south'
      when regexp_matches(id, '^doc_[0-9]*[02468]6_') then null when regexp_matches(id, '_v3$') then 'north' end as grp
  from rec
), rules(ord, rule_id, dims, lanes, special, about, good, bad, rmodes) as (values
  (0, 'SIL-001', ['clarity'], null::varchar[], true, 'outline reads at once', 'Outline holds at ${scorePct}%: ${groupShapes}', 'Outline fails at ${scorePct}%', []::varchar[]),
  (1, 'MAT-001', ['balance', 'detail'], null, true, 'materials fit the group', 'Uses ${groupMaterial} with ${groupWear} (${scorePct}%)', null, []),
  (2, 'PAL-001', ['balance'], null, false, 'palette stays in range', null, 'Off palette (${scorePct}%)', ['off_palette']),
  (3, 'SHP-001', ['clarity', 'balance', 'detail'], ['hull', 'costume'], false, 'shapes agree', null, null, ['too_busy']),
  (4, 'DET-001', ['detail'], ['tool', 'hall'], false, 'detail is useful', 'Detail at ${scorePct}%', 'Too little detail', ['too_busy'])
), vals as (
  select l.*, r.ord, r.rule_id, r.special, r.about, r.good, r.bad, len(list_intersect(l.modes, r.rmodes)) > 0 as hit,
    list_filter([case when list_contains(r.dims, 'clarity') then l.clarity end, case when list_contains(r.dims, 'balance') then l.balance end, case when list_contains(r.dims, 'detail') then l.detail end], lambda x: x is not null) as vs
  from loc l join rules r on (not r.special or l.grp is not null) and (r.lanes is null or list_contains(r.lanes, l.lane)) where l.status is not null
), means as (select *, list_sum(vs) / len(vs) as mean from vals where len(vs) > 0
), asr as (
  select *, case when status = 'rejected' then case when hit or mean < 0.4 then 'fail' when mean < 0.6 then 'partial' else 'pass' end
    when mean >= 0.7 then 'pass' when mean >= 0.5 then 'partial' else 'fail' end as verdict,
    floor(mean * 100 + 0.5) / 100 as score, cast(floor(mean * 100 + 0.5) as bigint)::varchar as pct
  from means
), canon as (
  select id, count(*)::bigint as an, count_if(verdict = 'pass')::bigint as pn, count_if(verdict = 'fail')::bigint as fn, list(rule_id order by ord) filter (verdict = 'fail') as failed, list(verdict order by ord) as verdicts
  from asr group by id
), bound as (select loc.*, an, pn, fn, coalesce(failed, []::varchar[]) as failed, verdicts from loc left join canon using (id)
), elig as (
  select *, list_filter([
    case when status is null then 'no_judgment' end, case when status <> 'approved' then 'wrong_status' end, case when an is null then 'not_canon_bound' end, case when an > 0 and pn / an::double < 0.5 then 'low_pass_ratio' end,
    case when lane = 'tool' then 'excluded_lane' end, case when rights <> 'cleared' then 'rights_filter' end, case when len(list_intersect(coalesce(tags, []), ['wip', 'draft'])) > 0 then 'excluded_tags' end], lambda x: x is not null) as codes,
    list_filter([
    case when status is null then 'no judgment (record has not been reviewed)' end, case when status <> 'approved' then 'status "'||status||'" not in [approved]' end, case when an is null then 'not canon-bound (no assertions)' end,
    case when an > 0 and pn / an::double < 0.5 then 'pass ratio '||cast(floor(pn / an::double * 100 + 0.5) as bigint)||'% below minimum 50%' end,
    case when lane = 'tool' then 'lane "tool" is excluded' end, case when rights <> 'cleared' then 'rights "'||rights||'" does not match required "cleared"' end,
    case when len(list_intersect(coalesce(tags, []), ['wip', 'draft'])) > 0 then 'has excluded tags: '||array_to_string(list_filter(tags, lambda t: t in ('wip', 'draft')), ', ') end], lambda x: x is not null) as messages
  from bound
)"""


def with_records(select: str, more: str = "") -> str:
    return f"with recursive {RECORDS_SQL.strip()}{more} {select}"
