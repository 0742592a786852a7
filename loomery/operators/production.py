"""The production loop as relations: seeds, slots, critique, refinement, selection, re-ingestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomery.functions.scalars import truthy


def _none() -> Column:
    return F.array().cast("array<string>")


# ---- ids and seeds -------------------------------------------------------------------


def next_sequence(names: DataFrame, column: str, prefix: str) -> DataFrame:
    """(next_id): the prefix and the highest three-digit number so far plus one."""
    number = truthy(F.regexp_extract(column, rf"\A{prefix}([0-9]{{3}})\z", 1)).cast("int")
    following = (F.coalesce(F.max(number), F.lit(0)) + 1).cast("string")
    return names.agg(F.concat(F.lit(prefix), F.lpad(following, 3, "0")).alias("next_id"))


def seed_plan(runs: DataFrame, mode: Column, base: Column, count: Column) -> DataFrame:
    """Rows of ``runs``, one per output, with output (from 0) and seed: fixed or base + output; random seeds are a hash of base and output, so that a plan repeats."""
    each = runs.withColumn("output", F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))))
    pseudo = F.pmod(F.xxhash64(base, F.col("output")), F.lit(2147483647))
    seed = F.when(mode == "fixed", base).when((mode == "random") & (F.col("output") > 0), pseudo).otherwise(base + F.col("output"))
    return each.withColumn("seed", seed.cast("bigint"))


def variations(subjects: DataFrame, kinds: DataFrame, base_seed: int) -> DataFrame:
    """Every subject with every variation (subject_ord, variation_ord); the ordinal advances for skipped ones too.

    Both are configuration lists; the variations are the smaller and are broadcast.
    """
    n = kinds.count()
    ordinal = F.col("subject_ord") * n + F.col("variation_ord")
    return subjects.crossJoin(F.broadcast(kinds)).withColumn("seed", (F.lit(base_seed) + ordinal + F.col("seed_offset")).cast("bigint"))


# ---- slots ---------------------------------------------------------------------------


def _tokens(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda s: F.lower(F.trim(s))), lambda s: s != "")


def _appended(parent: Column, items: Column) -> Column:
    """The text and those items whose token isn't in it yet."""
    have = _tokens(parent)
    new = F.filter(F.coalesce(items, _none()), lambda i: (F.trim(i) != "") & ~F.array_contains(have, F.lower(F.trim(i))))
    base = F.coalesce(parent, F.lit(""))
    return F.when(F.size(new) == 0, base).when(base == "", F.array_join(new, ", ")).otherwise(F.concat(base, F.lit(", "), F.array_join(new, ", ")))


def apply_slots(briefs: DataFrame, slots: DataFrame) -> DataFrame:
    """Every brief with every slot of its plan (mode_id): prompt and negative prompt with the slot's additions, and its runtime overrides."""
    added = F.coalesce("prompt_additions", _none())
    prompt = F.when(F.size(added) > 0, F.concat("prompt", F.lit(", "), F.array_join(added, ", "))).otherwise(F.col("prompt"))
    return briefs.join(slots, "mode_id").withColumns({"prompt": prompt, "negative_prompt": _appended(F.col("negative_prompt"), F.col("negative_additions"))}).drop("prompt_additions", "negative_additions")


def completed_slots(slots: DataFrame) -> DataFrame:
    """Slots that needn't run again: status ok, or an output from before there was a status."""
    return slots.where((F.col("status") == "ok") | (F.col("status").isNull() & truthy(F.col("selected_output")).isNotNull()))


def slots_to_run(planned: DataFrame, done: DataFrame) -> DataFrame:
    return planned.join(completed_slots(done).select("slot_id").distinct(), "slot_id", "left_anti")


def run_summary(outputs: DataFrame, by: str = "run_id") -> DataFrame:
    """Per run: outputs, ok, failed, total and mean elapsed time of those that are ok."""
    ok = F.col("status") == "ok"
    took = F.when(ok, F.col("elapsed_ms"))
    return outputs.groupBy(by).agg(F.count("*").alias("outputs"), F.count_if(ok).alias("ok"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed"), F.coalesce(F.sum(took), F.lit(0)).cast("bigint").alias("total_ms"), F.floor(F.avg(took) + 0.5).cast("bigint").alias("mean_ms"))


def successful(outputs: DataFrame) -> DataFrame:
    """Outputs that a critique can look at: made, or made in a dry run."""
    return outputs.where(F.col("status").isin("ok", "dry_run"))


# ---- critique ------------------------------------------------------------------------

# Dimensions in order, with the canon focus and the guard words that call for them.
DIMENSIONS = (
    ("subject_continuity", "subject", (), ("subject", "identity")),
    ("silhouette_read", "", ("silhouette",), ("silhouette",)),
    ("material_costume_logic", "", ("costume_logic", "material_language"), ("material", "costume")),
    ("palette_mood", "", ("palette", "lighting"), ("palette", "mood", "lighting", "color")),
    ("composition_framing", "", ("composition",), ("composition", "framing", "crop")),
    ("ornamental_drift", "", ("costume_logic", "faction_read"), ("ornament", "accessori", "extra")),
    ("era_faction_drift", "", ("era_logic", "faction_read"), ("era", "faction", "wrong")),
    ("identity_stability", "subject", (), ("identity", "face", "hairstyle", "age")),
    ("readability", "always", (), ("read", "clarity", "muddy", "clean")),
    ("lane_fit", "always", (), ("lane",)),
)


def active_dimensions(subject: Column, focus: Column, guards: Column, emphasis: list[str] | None = None) -> Column:
    """Dimensions that a brief calls for; emphasised ones first."""
    text = F.lower(F.array_join(F.coalesce(guards, _none()), " "))
    called = []
    for name, when, canon, words in DIMENSIONS:
        on = F.lit(when == "always")
        if when == "subject":
            on = on | truthy(subject).isNotNull()
        if canon:
            on = on | F.coalesce(F.arrays_overlap(focus, F.array(*map(F.lit, canon))), F.lit(False))
        for word in words:
            on = on | text.contains(word)
        called.append(F.when(on, F.lit(name)))
    active = F.filter(F.array(*called), lambda d: d.isNotNull())
    first = F.array(*map(F.lit, emphasis or [])).cast("array<string>")
    return F.array_union(F.array_intersect(first, active), active)


def recommend(candidates: DataFrame, by: str = "run_id") -> DataFrame:
    """One action a run: accept the first strong one, refine the usable one with the fewest issues, discard, or rerun.

    candidates: run_id, pos, filename, overall_fit, n_issues. Partial sums decide; no run is gathered.
    """
    fit = F.col("overall_fit")
    n = F.count("*")
    strong, usable, off = (F.count_if(fit == f) for f in ("strong", "usable", "off-model"))
    first = F.min(F.when(fit == "strong", F.struct("pos", "filename")))["filename"]
    fewest = F.min(F.when(fit == "usable", F.struct("n_issues", "pos", "filename")))["filename"]
    mode = F.when(strong > 0, "accept_one").when(usable > 0, "refine_from_one").when(off == n, "discard_run").otherwise("rerun_broader")
    return candidates.groupBy(by).agg(mode.alias("mode"), F.when(strong > 0, first).when(usable > 0, fewest).alias("preferred"), strong.alias("strong"), usable.alias("usable"), F.count_if(fit == "weak").alias("weak"), off.alias("off_model"))


def refine_delta(preserve: Column, correct: Column, drift: Column) -> Column:
    """struct(preserve, push, suppress); the check prefixes of drift notes fall away."""
    cleaned = F.transform(F.coalesce(drift, _none()), lambda d: F.trim(F.regexp_replace(F.regexp_replace(d, r"(?i)\A\[.*?\]\s*check:\s*", ""), r"(?i)\Anegative check:\s*", "")))
    return F.struct(F.coalesce(preserve, _none()).alias("preserve"), F.coalesce(correct, _none()).alias("push"), F.filter(cleaned, lambda d: d != "").alias("suppress"))


def refined_prompt(prompt: Column, delta: Column) -> Column:
    part = lambda name, items: F.when(F.size(items) > 0, F.concat(F.lit(f"[{name}: "), F.array_join(items, ", "), F.lit("]")))
    return F.concat_ws(", ", prompt, part("preserve", delta["preserve"]), part("emphasize", delta["push"]))


def refined_negative(negative: Column, delta: Column) -> Column:
    return _appended(negative, delta["suppress"])


# ---- selection and re-ingestion --------------------------------------------------------


def select_outputs(approved: DataFrame, outputs: DataFrame, by: str = "run_id") -> DataFrame:
    """Approved files (run_id, ord, filename) with their place in the selection and the seed of the first output of that name."""
    seeds = outputs.groupBy(by, "filename").agg(F.min_by("seed", "pos").alias("seed"))
    name = F.format_string("sel_%03d.png", F.row_number().over(Window.partitionBy(by).orderBy("ord")))
    return approved.withColumn("chosen", name).join(seeds, [by, "filename"], "left")


def item_provenance(items: DataFrame, slots: DataFrame, runs: DataFrame) -> DataFrame:
    """Selection items (slot_or_output 'slot:file', source_type, source_id) with their run: by slot for batches, by source for runs, else unknown."""
    slot = F.split("slot_or_output", ":")[0]
    via = items.withColumn("slot_id", F.when(F.col("source_type") == "batch", slot)).join(slots.select("slot_id", F.col("run_id").alias("slot_run")), "slot_id", "left")
    run = F.when(F.col("source_type") == "batch", F.col("slot_run")).otherwise(F.col("source_id"))
    known = runs.select(F.col("run_id").alias("_run"), "brief_id", "workflow_id")
    out = via.withColumn("wanted", run).join(known, F.col("wanted") == F.col("_run"), "left")
    found = F.col("_run").isNotNull()
    return out.select("slot_or_output", "source_type", "source_id", F.when(found, F.col("_run")).otherwise(F.col("source_id")).alias("run_id"), F.coalesce("brief_id", F.lit("unknown")).alias("brief_id"), F.coalesce("workflow_id", F.lit("unknown")).alias("workflow_id"))


def provenance_fingerprint(*parts: Column) -> Column:
    """Sixteen hex digits that identify how an output was made."""
    return F.substring(F.sha2(F.to_json(F.struct(*parts)), 256), 1, 16)


def to_ingest(found: DataFrame, records: DataFrame, prefix: str = "gen_") -> DataFrame:
    """Images that have no record yet: path, stem, record_id."""
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[A-Za-z0-9]+\z", "")
    image = F.lower("path").rlike(r"\.(png|jpg|jpeg|webp)\z")
    named = found.where(image).select("path", stem.alias("stem"), F.concat(F.lit(prefix), stem).alias("record_id"))
    return named.join(records.select(F.col("id").alias("record_id")), "record_id", "left_anti")


def reingest_audit(records: DataFrame, prefix: str = "gen_") -> DataFrame:
    """Reviewed, unreviewed, and of the reviewed bound and unbound, of re-ingested records."""
    ours = records.where(F.col("id").startswith(prefix))
    judged = F.col("judgment").isNotNull()
    bound = judged & (F.coalesce(F.size("canon.assertions"), F.lit(0)) > 0)
    return ours.agg(F.count("*").alias("total"), F.count_if(judged).alias("reviewed"), F.count_if(~judged).alias("unreviewed"), F.count_if(bound).alias("bound"), F.count_if(judged & ~bound).alias("unbound"))


def merged_tags(*lists: Column) -> Column:
    """All tags once, in order of first appearance."""
    return F.array_distinct(F.concat(*(F.coalesce(x, _none()) for x in lists)))
