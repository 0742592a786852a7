"""Record upkeep: judgments, comparisons, migration of older shapes, bulk curation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loomery.functions.scalars import strip_version, truthy
from loomery.schema import RECORD_SCHEMA_VERSION


#: The number that a text begins with, after blanks.
NUMBER = r"\A\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def leading_number(text: Column) -> Column:
    """The number at the beginning of a text, null where there is none."""
    return F.regexp_extract(text, NUMBER, 1).try_cast("double")


def _last_wins(pairs: Column, kind: str) -> Column:
    """Pairs (k, v) as a map; of repeated keys the last one counts."""
    none = F.array().cast(f"array<struct<k:string,v:{kind}>>")
    return F.map_from_entries(F.aggregate(pairs, none, lambda seen, p: F.array_append(F.filter(seen, lambda q: q["k"] != p["k"]), p)))


def parse_scores(text: Column, strict: bool = False) -> Column:
    """'a:0.9,b:0.4' as a map, the last of repeated keys. Pairs without a key or a value are left out; so are those without a number, which ``strict`` makes errors."""
    pairs = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda p: F.struct(F.trim(F.split(p, ":")[0]).alias("k"), F.try_element_at(F.split(p, ":"), F.lit(2)).alias("t")))
    given = F.filter(pairs, lambda p: (p["k"] != "") & (F.coalesce(p["t"], F.lit("")) != ""))

    def read(p: Column) -> Column:
        number = leading_number(p["t"])
        wrong = F.raise_error(F.concat(F.lit("score of "), p["k"], F.lit(" is not a number: "), p["t"])).cast("double")
        return F.struct(p["k"].alias("k"), (F.coalesce(number, wrong) if strict else number).alias("v"))

    return _last_wins(F.filter(F.transform(given, read), lambda p: p["v"].isNotNull()), "double")


def parse_pair_scores(text: Column) -> Column:
    """'a:0.9/0.6' pairs as a map of structs a, b."""
    half = lambda p, i: leading_number(F.try_element_at(F.split(F.try_element_at(F.split(p, ":"), F.lit(2)), "/"), F.lit(i)))
    pairs = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda p: F.struct(F.trim(F.split(p, ":")[0]).alias("k"), F.struct(half(p, 1).alias("a"), half(p, 2).alias("b")).alias("v")))
    return _last_wins(F.filter(pairs, lambda p: (p["k"] != "") & p["v"]["a"].isNotNull() & p["v"]["b"].isNotNull()), "struct<a:double,b:double>")


def curate(records: DataFrame, judgments: DataFrame) -> DataFrame:
    """A new version of the records: rows named in ``judgments`` (id, judgment) get that judgment."""
    new = judgments.select(F.col("id").alias("_id"), F.col("judgment").alias("_new"))
    out = records.join(new, F.col("id") == F.col("_id"), "left")
    return out.withColumn("judgment", F.when(F.col("_id").isNotNull(), F.col("_new")).otherwise(F.col("judgment"))).select(*records.columns)


def base(records: DataFrame, created_at: str) -> DataFrame:
    """Base records from (id, asset_path, width, height, bytes, provenance): format png, 1024 pixels and 0 bytes by default, nothing judged yet."""
    size = lambda name, default: F.coalesce(F.nullif(F.col(name), F.lit(0)), F.lit(default))
    image = F.struct(F.lit("png").alias("format"), size("width", 1024).alias("width"), size("height", 1024).alias("height"), F.coalesce("bytes", F.lit(0)).alias("bytes"))
    none = [F.lit(None).cast("string").alias(n) for n in ("judgment", "canon", "iteration")]
    return records.select("id", F.lit(RECORD_SCHEMA_VERSION).alias("schema_version"), F.lit(created_at).alias("created_at"), "asset_path", image.alias("image"), "provenance", *none)


def with_identity(base_records: DataFrame, blocks: DataFrame) -> DataFrame:
    """Base records with the identity and lineage of ``blocks`` (id, identity, lineage)."""
    return base_records.join(blocks.select("id", "identity", "lineage"), "id", "left")


def uncurated(records: DataFrame) -> DataFrame:
    return records.where(F.col("judgment").isNull())


def curated_counts(records: DataFrame) -> DataFrame:
    """(judged, n): records in all, curated, uncurated."""
    row = records.agg(F.count("*").alias("total"), F.count_if(F.col("judgment").isNotNull()).alias("curated"), F.count_if(F.col("judgment").isNull()).alias("uncurated"))
    return row.selectExpr("stack(3, 'total', total, 'curated', curated, 'uncurated', uncurated) as (judged, n)")


def compare(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairwise preferences (a_id, b_id, chosen) with both assets' paths; ``valid`` where both exist, differ and one of them, or a tie, was chosen."""
    a = records.select(F.col("id").alias("a_id"), F.col("asset_path").alias("a_path"), F.lit(True).alias("_a"))
    b = records.select(F.col("id").alias("b_id"), F.col("asset_path").alias("b_path"), F.lit(True).alias("_b"))
    out = pairs.join(a, "a_id", "left").join(b, "b_id", "left")
    valid = F.coalesce(F.col("_a") & F.col("_b") & (F.col("a_id") != F.col("b_id")) & F.col("chosen").isin("a", "b", "tie"), F.lit(False))
    return out.withColumn("valid", valid).drop("_a", "_b")


def migrate(old: DataFrame, approved_files: DataFrame) -> DataFrame:
    """(id, action, status, asset_path) for records of the older flat shape.

    old: id, verdict, is_identity, judged, asset_path. A candidate's path moves
    to the approved folder where the file is there (approved_files: path).
    """
    there = approved_files.select(F.col("path").alias("_moved")).distinct()
    moved = F.replace("asset_path", F.lit("outputs/candidates/"), F.lit("outputs/approved/"))
    out = old.withColumn("_to", F.when(F.col("asset_path").contains("outputs/candidates/"), moved)).join(there, F.col("_to") == F.col("_moved"), "left")
    divergent, fixed = F.col("verdict").isNotNull() & ~F.col("judged"), F.col("_moved").isNotNull()
    action = F.when(F.col("is_identity"), "skip-identity").when(divergent, "migrated").when(fixed, "path-fix-only").otherwise("skip-standard")
    path = F.when(~F.col("is_identity") & fixed, F.col("_moved")).otherwise(F.col("asset_path"))
    status = F.when(~F.col("is_identity") & divergent, F.coalesce(truthy(F.col("verdict")), F.lit("unknown")))
    return out.select("id", action.alias("action"), status.alias("status"), path.alias("asset_path"))


def bulk_status(record_id: Column, rejected: list[str], borderline_prefix: str = "BORDERLINE_") -> Column:
    """Rejected by base id, borderline by prefix, approved otherwise."""
    return F.when(strip_version(record_id).isin(*rejected), "rejected").when(record_id.startswith(borderline_prefix), "borderline").otherwise("approved")


def profile_by_prefix(record_id: Column, prefixes: dict[str, str], default: str = "prop") -> Column:
    """Score profile of the first prefix that fits."""
    out = F.lit(default)
    for prefix, name in reversed(list(prefixes.items())):
        out = F.when(record_id.startswith(prefix), name).otherwise(out)
    return out
