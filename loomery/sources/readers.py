"""Readers. Files are listed and read by Spark, so any path that Spark opens will do."""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loomery import schema
from loomery.config import InputError
from loomery.functions.scalars import either

_CORRUPT = "_corrupt_record"
#: Schema version that manifests state.
MANIFEST_VERSION = "2.2.0"


def records(spark: SparkSession, path: str, on_error: str = "collect") -> DataFrame:
    """Record documents (*.json, one a file) plus file. on_error: collect keeps bad files as rows with ``error``, skip drops them, fail raises."""
    reader = spark.read.option("multiLine", True).option("pathGlobFilter", "*.json")
    named = F.col("_metadata.file_name").alias("file")
    if on_error == "fail":
        return reader.option("mode", "FAILFAST").schema(schema.RECORD).json(path).select("*", named)
    read = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).schema(f"{schema.RECORD.strip()}, {_CORRUPT} string").json(path)
    if on_error == "skip":
        return read.select("*", named).where(F.col(_CORRUPT).isNull() & F.col("id").isNotNull()).drop(_CORRUPT)
    bad = F.col(_CORRUPT).isNotNull() | F.col("id").isNull()
    return read.select("*", named).withColumn("error", F.when(bad, "unreadable record file")).drop(_CORRUPT)


def unreadable(collected: DataFrame) -> DataFrame:
    """(record_id, file, error) of a scan that collected its errors."""
    return collected.where(F.col("error").isNotNull()).select(F.regexp_replace("file", r"\.json\z", "").alias("record_id"), "file", "error")


def lookup(wanted: DataFrame, all_records: DataFrame) -> DataFrame:
    """Records of the wanted ids (id); ids without one give a row of nulls."""
    return wanted.select("id").distinct().join(all_records, "id", "left")


def json_lines(spark: SparkSession, path: str, ddl: str, strict: bool = False) -> DataFrame:
    """JSON lines with a declared schema; blank lines are no rows. ``strict`` fails at a malformed one."""
    return spark.read.option("mode", "FAILFAST" if strict else "PERMISSIVE").schema(ddl).json(path)


def manifests(spark: SparkSession, root: str, ddl: str) -> DataFrame:
    """Every */manifest.json below root, malformed ones skipped, newest first."""
    read = spark.read.option("multiLine", True).option("mode", "DROPMALFORMED").schema(ddl).json(f"{root.rstrip('/')}/*/manifest.json")
    return newest_first(read, "created_at") if "created_at" in read.columns else read


def manifest(spark: SparkSession, path: str, expected: str = MANIFEST_VERSION) -> dict:
    """One manifest file. Another schema version than expected, or none, only gives a warning."""
    rows = spark.read.text(path, wholetext=True).head(1)
    try:
        found = json.loads(rows[0][0]) if rows else None
    except ValueError as e:
        raise InputError("MANIFEST_INVALID", f"{path} is not valid JSON ({e})") from e
    if not isinstance(found, dict):
        raise InputError("MANIFEST_INVALID", f"{path} is not a JSON object")
    if found.get("schema_version") != expected:
        logging.getLogger(__name__).warning("%s has schema_version %s, expected %s", path, found.get("schema_version"), expected)
    return found


def newest_first(rows: DataFrame, time: str, *ties: str) -> DataFrame:
    return rows.orderBy(F.col(time).desc(), *ties)


def latest(rows: DataFrame, by: str, time: str, tie: str) -> DataFrame:
    """(by, time, tie) of the newest row of each key, the greatest ``tie`` where times are equal."""
    newest = F.max(F.struct(time, tie)).alias("newest")
    return rows.groupBy(by).agg(newest).select(by, f"newest.{time}", f"newest.{tie}")


def images(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """Image files below a folder: path, length, modificationTime, extension, and their bytes if asked for."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)\z", 1))
    kept = read.withColumn("extension", ext).where(F.col("extension").isin("png", "jpg", "jpeg", "webp"))
    return kept if content else kept.drop("content")


FRONT_MATTER = "frontmatter string, body string, error string"


def split_front_matter(text: str) -> tuple[str | None, str | None, str | None]:
    """(front matter as JSON, body, error) of a Markdown text; carriage returns and a byte-order mark are tolerated."""
    import yaml

    lines = text.replace("\r\n", "\n").removeprefix("\ufeff").lstrip()
    if not lines.startswith("---"):
        return None, None, "no front matter fence at the beginning"
    opening, newline, rest = lines.partition("\n")
    if not newline:
        return None, None, "no line after the opening fence"
    # the closing fence is a line of its own
    block, found, body = [], False, rest
    for line in rest.split("\n"):
        body = body[len(line) + 1 :]
        if line == "---":
            found = True
            break
        block.append(line)
    if not found or not block:
        return None, None, "no closing fence"
    try:
        value = yaml.safe_load("\n".join(block))
    except yaml.YAMLError as e:
        return None, None, f"front matter is not valid YAML ({str(e).splitlines()[0]})"
    if not isinstance(value, dict):
        return None, None, f"front matter must be a mapping, not {type(value).__name__}"
    return json.dumps(value, ensure_ascii=False, default=str), body.lstrip("\n"), None


def front_matter(text: Column) -> Column:
    """struct(frontmatter, body, error); YAML has no built-in parser, so a vectorised function reads it."""

    @F.pandas_udf(FRONT_MATTER)
    def parse(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([split_front_matter(t or "") for t in batch], columns=["frontmatter", "body", "error"])

    return parse(text)


def entries(spark: SparkSession, path: str, schema_kind: str) -> DataFrame:
    """Markdown entries of a folder: id, schema_kind, entry (JSON), body, error, file, source. The id is the front matter's, else the file's stem."""
    read = spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True)
    parsed = read.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("source"), front_matter(F.col("value")).alias("p"))
    stem = F.regexp_replace("file", r"\.md\z", "")
    return parsed.select(either(F.get_json_object("p.frontmatter", "$.id"), stem).alias("id"), F.lit(schema_kind).alias("schema_kind"), F.col("p.frontmatter").alias("entry"), "p.body", "p.error", "file", "source")


def schema_versions(spark: SparkSession, path: str) -> DataFrame:
    """(schema_kind, schema_version) of JSON schema files: the version they state, else a hash of their bytes."""
    read = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    stated = F.get_json_object(F.col("content").cast("string"), "$.version")
    name = F.regexp_extract("path", r"([^/]+?)(?:\.schema)?\.json\z", 1)
    return read.select(name.alias("schema_kind"), F.coalesce(stated, F.concat(F.lit("content-sha:"), F.sha2("content", 256))).alias("schema_version"))


def pick_output(images_by_node: Column, hint: Column) -> Column:
    """The hinted node's file, else that of the highest numbered node, else the first. images_by_node: array<struct<node, filename>>."""
    hinted = F.filter(images_by_node, lambda x: x["node"] == hint)
    numbered = F.filter(F.transform(images_by_node, lambda x, i: F.struct(x["node"].try_cast("double").alias("n"), (-i).alias("i"), x["filename"].alias("filename"))), lambda x: x["n"].isNotNull())
    return F.coalesce(F.try_element_at(hinted, F.lit(1))["filename"], F.array_max(numbered)["filename"], F.try_element_at(images_by_node, F.lit(1))["filename"])
