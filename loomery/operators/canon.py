"""Canon entries: rows, incremental builds by content hash, freezes and drift."""

from __future__ import annotations

import hashlib
import json
import math
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from loomery.functions import canonical as canonical_json, captions
from loomery.config import InputError
from loomery.operators.numbering import numbered
from loomery.functions.scalars import either, row_hash, truthy
from loomery.schema import ROW_SCHEMA_VERSION

STATUSES = ("auto", "soft-advisory", "frozen", "on-canon-change")


def by_path(value: Any, path: str) -> Any:
    """The value at a dotted path of nested dictionaries; None where it ends early."""
    for key in path.split("."):
        if not isinstance(value, dict):
            return None
        value = value.get(key)
    return value


def number_text(value: float) -> str:
    """The shortest decimal text of a double: plain from 1e-6 up to below 1e21, else with an exponent; non-finite ones are null."""
    if not math.isfinite(value):
        return "null"
    sign, digits, exponent = Decimal(repr(float(value))).normalize().as_tuple()
    text, point = "".join(map(str, digits)), len(digits) + exponent
    minus = "-" if sign and value else ""
    if value == 0:
        return "0"
    if len(text) <= point <= 21:
        return minus + text + "0" * (point - len(text))
    if 0 < point <= 21:
        return f"{minus}{text[:point]}.{text[point:]}"
    if -6 < point <= 0:
        return f"{minus}0.{'0' * -point}{text}"
    fraction = f".{text[1:]}" if len(text) > 1 else ""
    return f"{minus}{text[0]}{fraction}e{point - 1:+d}"


def canonical(value: Any) -> str:
    """JSON without blanks, keys in order of their UTF-16 units, numbers as doubles are written."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{canonical(value[k])}" for k in sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return number_text(value)
    return json.dumps(value, ensure_ascii=False)


def watch_hash(entry: dict, fields: list[str], schema_version: str) -> str:
    """Hash of the watched fields and the schema version; other fields and the body don't enter."""
    payload = {"schema_version": schema_version, "watched": {f: by_path(entry, f) for f in fields}}
    return hashlib.sha256(canonical(payload).encode()).hexdigest()


def freeze_status(entry: Column) -> Column:
    status = F.get_json_object(entry, "$.freeze.status")
    return F.when(status.isin(*STATUSES), status).otherwise("auto")


def watched_fields(entry: Column, kind: Column, defaults: dict[str, list[str]]) -> Column:
    """The entry's own list if it has one, else its kind's default, else none."""
    own = F.from_json(F.get_json_object(entry, "$.freeze.watch_fields"), "array<string>")
    out = F.array().cast("array<string>")
    for name, fields in defaults.items():
        out = F.when(kind == name, F.array(*map(F.lit, fields)).cast("array<string>")).otherwise(out)
    return F.when(F.size(own) > 0, own).otherwise(out)


def with_watch_hash(entries: DataFrame, defaults: dict[str, list[str]]) -> DataFrame:
    """entries (id, schema_kind, entry JSON, schema_version) with freeze_status, watch_fields and watch_hash."""

    out = entries.withColumns({"freeze_status": freeze_status(F.col("entry")), "watch_fields": watched_fields(F.col("entry"), F.col("schema_kind"), defaults)})
    return out.withColumn("watch_hash", canonical_json.watch_hash(F.col("entry"), F.col("watch_fields"), F.col("schema_version")))


def drift(now: DataFrame, before: DataFrame) -> DataFrame:
    """(id, freeze_status, drift): drifted, clean or no-witness for every entry whose status isn't auto.

    ``before`` has id and witness_hash of an earlier build.
    """
    watched = now.where(F.col("freeze_status") != "auto")
    state = F.when(F.col("witness_hash").isNull(), "no-witness").when(F.col("witness_hash") == F.col("watch_hash"), "clean").otherwise("drifted")
    return watched.join(before.select("id", "witness_hash"), "id", "left").select("id", "freeze_status", state.alias("drift"))


def lanes_of(entries: DataFrame, by_kind: dict[str, dict[str, str]]) -> DataFrame:
    """Adds lane and lane_error. A kind's rule is {"field": path} or {"lane": constant}."""
    lane, error = F.lit(None).cast("string"), F.lit("no lane rule for this kind")
    for kind, rule in by_kind.items():
        here = F.col("schema_kind") == kind
        if "field" in rule:
            value = truthy(F.get_json_object("entry", f"$.{rule['field']}"))
            lane, error = F.when(here, value).otherwise(lane), F.when(here, F.when(value.isNull(), f"field {rule['field']} is missing")).otherwise(error)
        elif "lane" in rule:
            lane, error = F.when(here, rule["lane"]).otherwise(lane), F.when(here, F.lit(None).cast("string")).otherwise(error)
        else:
            error = F.when(here, "lane rule names neither field nor lane").otherwise(error)
    return entries.withColumns({"lane": lane, "lane_error": error})


def hashed(entries: DataFrame, build_config: str, project_fingerprint: str) -> DataFrame:
    """Adds entry_hash over source text, schema version, build configuration and project fingerprint."""
    return entries.withColumn("entry_hash", row_hash(F.col("source"), F.col("schema_version"), F.lit(build_config), F.lit(project_fingerprint)))


def to_build(entries: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries to render, cached renderings that still hold): an anti- and a semi-join on the hash."""
    return entries.join(cache.select("entry_hash").distinct(), "entry_hash", "left_anti"), cache.join(entries.select("entry_hash").distinct(), "entry_hash", "left_semi")


def changed_schemas(now: DataFrame, before: DataFrame) -> DataFrame:
    """(schema_kind, schema_version) pairs that the earlier build hasn't; any of them rebuilds everything."""
    return now.select("schema_kind", "schema_version").distinct().exceptAll(before.select("schema_kind", "schema_version").distinct())


def rows(entries: DataFrame, trigger: str | None, generated_from: str | None, partition: str = "train") -> DataFrame:
    """Training rows of entries that have lane and entry_hash."""
    none = F.array().cast("array<string>")
    return entries.select(
        F.lit(ROW_SCHEMA_VERSION).alias("schema_version"), F.lit(generated_from).cast("string").alias("generated_from"), F.col("id").alias("entity_id"), "schema_kind", captions.entity_type(F.col("entry")).alias("entity_type"),
        "lane", F.lit(partition).alias("partition"), F.get_json_object("entry", "$.reference_plate").alias("asset_path"), captions.entity_caption(F.col("entry"), F.col("schema_kind"), trigger).alias("caption"),
        F.lit(trigger).cast("string").alias("trigger"), F.col("id").alias("subject_filter_key"), F.coalesce(F.from_json(F.get_json_object("entry", "$.forbidden_inputs"), "array<string>"), none).alias("forbidden_tokens"), "entry_hash",
    )


def over_length(rendered: DataFrame, cap: int) -> DataFrame:
    """Entries whose context has more lines than allowed; a build with any of them fails."""
    lines = F.size(F.split("context", "\n"))
    return rendered.withColumn("lines", lines).where(F.col("lines") > cap)


def tree_hash(files: DataFrame, fan: int = 256) -> DataFrame:
    """(content_sha) over all files (path, content): a fallback where there is no revision.

    A tree over the paths in their order: the hashes of ``fan`` neighbours make one of the next level, up to the root.
    Which neighbours meet depends on the files alone, so the root is the same however the table is partitioned,
    and no row holds more than ``fan`` hashes. Paths are numbered by ranges. No files have the hash of nothing.
    """
    leaf = F.sha2(F.concat(F.col("path"), F.lit("\0"), F.sha2(F.col("content"), 256)), 256)
    level = numbered(files.select("path", leaf.alias("hash")), ["path", "hash"], name="at").select("at", "hash")
    count = level.count()
    while count > 1:
        # equal paths are told apart by their contents, so the order within a node is that of the numbers
        ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "hash"))), lambda x: x["hash"]), "\n")
        level = level.groupBy(F.floor(F.col("at") / fan).alias("node")).agg(F.sha2(ordered, 256).alias("hash")).select(F.col("node").alias("at"), "hash")
        count = -(-count // fan)
    root = F.coalesce(F.max("hash"), F.sha2(F.lit("").cast("binary"), 256))
    return level.agg(F.concat(F.lit("content-sha:"), root).alias("content_sha"))


def events_after(events: DataFrame, build_hash: str | None, position: str = "pos") -> DataFrame:
    """Events behind the last one of a build; all where the build isn't there or isn't given."""
    if build_hash is None:
        return events
    last = events.where(F.col("build_hash") == build_hash).agg(F.coalesce(F.max(position), F.lit(-1)).alias("_last"))
    return events.join(F.broadcast(last), F.col(position) > F.col("_last")).drop("_last")


def events_of(events: DataFrame, entity_id: str) -> DataFrame:
    return events.where(F.col("entity_id") == entity_id)


def gate(entries: DataFrame, allow_advisory: bool = False, reason: str | None = None) -> DataFrame:
    """(id, freeze_status, decision): refused, bypassed or allowed. Frozen is always refused; advisory needs the flag and a reason."""
    bypass = bool(allow_advisory and reason)
    decision = F.when(F.col("freeze_status") == "frozen", "refused").when(F.col("freeze_status") == "soft-advisory", "bypassed" if bypass else "refused").otherwise("allowed")
    return entries.select("id", "freeze_status", decision.alias("decision"))


def bypass_events(gated: DataFrame, reason: str, by: str, at: str, kinds: DataFrame | None = None) -> DataFrame:
    """Events to append to the freeze log for each bypassed entry of ``gate``; ``kinds`` (id, schema_kind) names their kinds."""
    passed = gated.where(F.col("decision") == "bypassed")
    passed = passed.join(kinds.select("id", "schema_kind"), "id", "left") if kinds is not None else passed.withColumn("schema_kind", F.lit(None).cast("string"))
    status = F.lit("soft-advisory")
    return passed.select(F.lit(at).alias("at"), F.lit("bypass").alias("type"), F.col("id").cast("string").alias("entity_id"), "schema_kind", F.lit(by).alias("by"), F.lit(reason).alias("reason"), status.alias("prior_status"), status.alias("new_status"))


def freeze_events(entries: DataFrame, new_status: str, reason: str, by: str, at: str) -> DataFrame:
    """Events of setting entries (id, schema_kind, freeze_status) to a status: freeze, or unfreeze for auto; entries that have it already give none."""
    if new_status not in STATUSES:
        raise InputError("FREEZE_STATUS", f"no freeze status {new_status!r}", f"known: {', '.join(STATUSES)}")
    if not reason:
        raise InputError("FREEZE_REASON", "a reason is required")
    kind = "unfreeze" if new_status == "auto" else "freeze"
    changed = entries.where(F.col("freeze_status") != new_status)
    return changed.select(F.lit(at).alias("at"), F.lit(kind).alias("type"), F.col("id").alias("entity_id"), "schema_kind", F.lit(by).alias("by"), F.lit(reason).alias("reason"), F.col("freeze_status").alias("prior_status"), F.lit(new_status).alias("new_status"))


def of_subjects(subjects: DataFrame, entries: DataFrame) -> DataFrame:
    """(subject, id, schema_kind, freeze_status): the entry of each subject's id; nulls where nothing is bound."""
    return subjects.join(entries.select(F.col("id").alias("subject"), "id", "schema_kind", "freeze_status"), "subject", "left")


def of_assets(assets: DataFrame, entries: DataFrame) -> DataFrame:
    """(asset_path, id, schema_kind, freeze_status): the entry whose reference plate an asset is, by paths with forward slashes."""
    plate = either(F.get_json_object("entry", "$.visual.reference_plate_uri"), F.get_json_object("entry", "$.reference_plate_uri"))
    slashed = lambda c: F.translate(c, "\\", "/")
    plates = entries.select(slashed(plate).alias("_plate"), "id", "schema_kind", "freeze_status").where(truthy(F.col("_plate")).isNotNull())
    # of several entries with one plate the first id counts
    first = plates.groupBy("_plate").agg(F.min(F.struct("id", "schema_kind", "freeze_status")).alias("_e"))
    return assets.join(first, slashed(F.col("asset_path")) == F.col("_plate"), "left").select("asset_path", "_e.id", "_e.schema_kind", "_e.freeze_status")


def build_stats(entries: DataFrame, drifted: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """(name, n): entries, frozen, drifted, rebuilt, cached; one aggregate for each table."""
    first = entries.agg(F.count("*").alias("entries"), F.count_if(F.col("freeze_status") != "auto").alias("frozen"))
    second, third = drifted.agg(F.count_if(F.col("drift") == "drifted").alias("drifted")), rebuilt.agg(F.count("*").alias("rebuilt"))
    one = lambda d: d.withColumn("_one", F.lit(1))
    row = one(first).join(one(second), "_one").join(one(third), "_one")
    return row.selectExpr("stack(5, 'entries', entries, 'frozen', frozen, 'drifted', drifted, 'rebuilt', rebuilt, 'cached', entries - rebuilt) as (name, n)")
