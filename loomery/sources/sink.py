"""A sink for files: tasks place them and report, a commit publishes them all at once.

``spark.write.format("loomery_files")`` takes rows (record_id, name, source, content). Tasks
write below a staging folder, each file under a name of its own and then renamed, so that a
file is whole or absent and a task that runs twice leaves one. A file that can't be
placed is a row of the result, not the end of the job. The commit renames the staging folder; until then, and after
an abort, nothing shows. Tasks can outlive the abort of their job and write once more; ``place`` waits for them and clears up.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from loomery.config import InputError

SCHEMA = "record_id string, name string, source string, content binary"
STATUSES = ("placed", "source_missing", "copy_failed", "link_failed")
REPORT, FAILURES = "_report.json", "_failures"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark's filesystem sees it; resolved once, on the driver."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return f"file://{full.removeprefix('file:')}" if full.startswith("file:/") and not full.startswith("file:///") else full


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The filesystem of a URI or absolute path, and the path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


@dataclass
class Placed(WriterCommitMessage):
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(STATUSES, 0))
    failures: str | None = None
    sample: list[dict] = field(default_factory=list)


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.root, self.mode = options["root"].rstrip("/"), options.get("placement", "copy")
        self.staging = f"{self.root}.staging-{options.get('attempt') or uuid.uuid4().hex[:8]}"

    def _place(self, target: fs.FileSystem, at: str, source: str | None, content: bytes | None) -> str:
        """The status of one file; raises what went wrong while it was written."""
        if content is None:
            if not source:
                return "source_missing"
            origin, path = opened(source)
            if origin.get_file_info(path).type != fs.FileType.File:
                return "source_missing"
        target.create_dir(at.rpartition("/")[0], recursive=True)
        if self.mode == "link":
            if content is not None or not isinstance(target, fs.LocalFileSystem) or not isinstance(origin, fs.LocalFileSystem):
                raise OSError("links need a source and local filesystems")
            final = self.root.removeprefix("file://") + at.removeprefix(opened(self.staging)[1])
            link = f"{at}.{uuid.uuid4().hex}"
            os.symlink(os.path.relpath(path, os.path.dirname(final)), link)
            os.replace(link, at)
            return "placed"
        partial = f"{at}.{uuid.uuid4().hex}.partial"
        try:
            with target.open_output_stream(partial) as out:
                if content is not None:
                    out.write(content)
                else:
                    with origin.open_input_stream(path) as data:
                        while block := data.read(1 << 20):
                            out.write(block)
            target.move(partial, at)
        except Exception:
            if target.get_file_info(partial).type == fs.FileType.File:
                target.delete_file(partial)
            raise
        return "placed"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        target, base = opened(self.staging)
        done, failed = Placed(), []
        for batch in iterator:
            for i in range(len(batch)):
                record, name, source = (batch.column(c)[i].as_py() for c in ("record_id", "name", "source"))
                detail = None
                try:
                    if not name or name.startswith("/") or ".." in name.split("/"):
                        raise OSError(f"not a name below the root: {name!r}")
                    status = self._place(target, f"{base}/{name}", source, batch.column("content")[i].as_py())
                except Exception as e:  # whatever hinders one file is that file's status
                    status, detail = f"{'link' if self.mode == 'link' else 'copy'}_failed", f"{type(e).__name__}: {e}"[:500]
                done.counts[status] += 1
                if status != "placed":
                    failed.append({"record_id": record, "name": name, "reason": status, "detail": detail})
        if failed:
            done.failures, done.sample = f"part-{uuid.uuid4().hex}.json", failed[:10]
            target.create_dir(f"{base}/{FAILURES}", recursive=True)
            with target.open_output_stream(f"{base}/{FAILURES}/{done.failures}") as out:
                out.write("".join(json.dumps(f, ensure_ascii=False) + "\n" for f in failed).encode())
        return done

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        target, base = opened(self.staging)
        known = [m for m in messages if m is not None]
        target.create_dir(base, recursive=True)
        # an attempt that lost has left a report that no message names
        folder = f"{base}/{FAILURES}"
        if target.get_file_info(folder).type == fs.FileType.Directory:
            named = {m.failures for m in known}
            for info in target.get_file_info(fs.FileSelector(folder)):
                if info.base_name not in named:
                    target.delete_file(info.path)
        report = {"counts": {s: sum(m.counts[s] for m in known) for s in STATUSES}, "sample": sorted((f for m in known for f in m.sample), key=lambda f: str(f["record_id"]))[:10]}
        with target.open_output_stream(f"{base}/{REPORT}") as out:
            out.write(json.dumps(report, ensure_ascii=False).encode())
        final = opened(self.root)[1]
        if target.get_file_info(final).type != fs.FileType.NotFound:
            target.delete_dir(base)
            raise FileExistsError(f"{self.root} is there already")
        target.create_dir(final.rpartition("/")[0], recursive=True)
        target.move(base, final)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        target, base = opened(self.staging)
        if target.get_file_info(base).type == fs.FileType.Directory:
            target.delete_dir(base)


class FilesSink(DataSource):
    """``loomery_files``: options root (a URI, not there yet) and placement (copy or link)."""

    @classmethod
    def name(cls) -> str:
        return "loomery_files"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return FilesWriter(dict(self.options))


def _ended(spark: SparkSession, tag: str) -> bool:
    """Whether no task of the jobs with this tag runs any more."""
    tracker = spark.sparkContext.statusTracker()
    jobs = [j for i in spark.sparkContext._jsc.sc().statusTracker().getJobIdsForTag(tag) if (j := tracker.getJobInfo(i))]
    stages = [s for j in jobs for i in j.stageIds if (s := tracker.getStageInfo(i))]
    return all(j.status != "RUNNING" for j in jobs) and not any(s.numActiveTasks for s in stages)


def _clear(spark: SparkSession, tag: str, staging: str, patience: float = 60.0) -> None:
    """Delete what a failed job has left, once its last tasks have ended or ``patience`` has (seconds)."""
    until = time.monotonic() + patience
    while not _ended(spark, tag) and time.monotonic() < until:
        time.sleep(0.05)
    target, base = opened(staging)
    while target.get_file_info(base).type != fs.FileType.NotFound and time.monotonic() < until + patience:
        try:
            target.delete_dir(base)
        except OSError:  # a worker that is being ended puts a file there
            pass
        time.sleep(0.1)


def place(files: DataFrame, root: str, mode: str = "copy") -> dict:
    """Place files (name, and record_id, source, content where there are any) below ``root``, and give the report: counts by status, and the first failures.

    All failures are rows of ``failures``. ``root`` must not exist.
    """
    if mode not in ("copy", "link"):
        raise InputError("PLACEMENT_UNKNOWN", f"no placement {mode!r}", "known: copy, link")
    spark = files.sparkSession
    spark.dataSource.register(FilesSink)
    have = {"record_id": "string", "name": "string", "source": "string", "content": "binary"}
    given = files.select(*((F.col(c) if c in files.columns else F.lit(None)).cast(kind).alias(c) for c, kind in have.items()))
    full = qualified(spark, root)
    attempt = uuid.uuid4().hex[:8]
    tag = f"loomery-files-{attempt}"
    spark.sparkContext.addJobTag(tag)
    try:
        given.write.format("loomery_files").option("root", full).option("placement", mode).option("attempt", attempt).mode("append").save()
    except Exception:
        _clear(spark, tag, f"{full.rstrip('/')}.staging-{attempt}")
        raise
    finally:
        spark.sparkContext.removeJobTag(tag)
    target, base = opened(full)
    with target.open_input_stream(f"{base}/{REPORT}") as data:
        return json.loads(data.read())


def failures(spark: SparkSession, root: str) -> DataFrame:
    """(record_id, name, reason, detail) of what could not be placed."""
    target, base = opened(qualified(spark, root))
    schema = "record_id string, name string, reason string, detail string"
    if target.get_file_info(f"{base}/{FAILURES}").type == fs.FileType.NotFound:
        return spark.createDataFrame([], schema)
    # names that begin with an underscore are hidden from a plain listing
    return spark.read.schema(schema).json(f"{root.rstrip('/')}/{FAILURES}/*.json")
