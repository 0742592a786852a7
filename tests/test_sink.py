"""The sink for files: statuses, commit and abort."""

import os
import time

import pytest
from pyspark.sql import functions as F

from loomery.config import InputError
from loomery.sources import sink


def tree(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*") if not p.is_dir() and "_" not in p.name[:1] and sink.FAILURES not in str(p))


@pytest.fixture
def files(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    for i in range(20):
        (source / f"{i}.png").write_bytes(bytes([i]) * 1000)
    (source / "folder.png").mkdir()
    rows = [(f"r{i}", f"images/{i % 3}/r{i}.png", str(source / f"{i}.png"), None) for i in range(20)]
    rows += [("gone", "images/gone.png", str(source / "none.png"), None), ("folder", "images/folder.png", str(source / "folder.png"), None), ("none", "images/none.png", None, None), ("out", "../out.png", str(source / "1.png"), None), ("text", "captions/text.txt", None, b"said"), ("empty", "captions/empty.txt", None, b"")]
    return spark.createDataFrame(rows, sink.SCHEMA).repartition(4)


def test_copies(spark, files, tmp_path):
    root = tmp_path / "out" / "package"
    report = sink.place(files, str(root))
    assert report["counts"] == {"placed": 22, "source_missing": 3, "copy_failed": 1, "link_failed": 0}
    assert [f["record_id"] for f in report["sample"]] == ["folder", "gone", "none", "out"]
    got = {(r["record_id"], r["reason"]) for r in sink.failures(spark, str(root)).collect()}
    assert got == {("gone", "source_missing"), ("folder", "source_missing"), ("none", "source_missing"), ("out", "copy_failed")}
    assert (root / "images/1/r7.png").read_bytes() == bytes([7]) * 1000 and (root / "captions/empty.txt").read_bytes() == b""
    assert len(tree(root)) == 22 and not (tmp_path / "out" / "out.png").exists()
    assert os.listdir(tmp_path / "out") == ["package"]  # no staging folder is left
    with pytest.raises(Exception, match="there already"):
        sink.place(files, str(root))
    assert len(tree(root)) == 22 and os.listdir(tmp_path / "out") == ["package"]


def test_links(spark, files, tmp_path):
    root = tmp_path / "linked"
    report = sink.place(files, str(root), "link")
    assert report["counts"] == {"placed": 20, "source_missing": 3, "copy_failed": 0, "link_failed": 3}
    link = root / "images/2/r5.png"
    assert link.is_symlink() and not os.path.isabs(os.readlink(link)) and link.read_bytes() == bytes([5]) * 1000
    assert {r["detail"] is None for r in sink.failures(spark, str(root)).where("reason = 'link_failed'").collect()} == {False}


def test_a_job_that_fails_leaves_nothing(spark, files, tmp_path):
    bad = files.withColumn("content", F.when(F.col("record_id") == "r3", F.raise_error(F.lit("broken row")).cast("binary")).otherwise(F.col("content")))
    with pytest.raises(Exception, match="broken row"):
        sink.place(bad, str(tmp_path / "out" / "p"))
    assert not (tmp_path / "out" / "p").exists() and not list(tmp_path.glob("out/*staging*"))
    with pytest.raises(InputError):
        sink.place(files, str(tmp_path / "x"), "move")


def test_nothing_to_place(spark, files, tmp_path):
    report = sink.place(files.limit(0).select("name"), str(tmp_path / "none"))
    assert sum(report["counts"].values()) == 0 and sink.failures(spark, str(tmp_path / "none")).count() == 0


def test_tasks_that_outlive_their_job_leave_nothing(spark, tmp_path):
    def given(batches):
        for batch in batches:
            if batch.column(0)[0].as_py() == 0:
                time.sleep(3)
                raise ValueError("broken row")
            yield batch

    # one part fails while the other has its files under way
    ids = spark.range(20000, numPartitions=2).mapInArrow(given, "id bigint")
    files = ids.select(F.col("id").cast("string").alias("record_id"), F.concat(F.lit("d/"), "id").alias("name"), F.lit("x").cast("binary").alias("content"))
    with pytest.raises(Exception, match="broken row"):
        sink.place(files, str(tmp_path / "out" / "p"))
    assert not list(tmp_path.glob("out/*"))
    time.sleep(2)
    assert not list(tmp_path.glob("out/*"))
