"""Merges into state tables, and builds in a row."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from loomery.config import InputError
from loomery.operators import canon
from loomery.sources import builds, state

ENTRY = "id string, schema_kind string, entry string, source string, schema_version string"


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def content(spark, path, schema):
    return sorted((tuple(r) for r in state.read(spark, str(path), schema).collect()), key=repr)


def test_upsert(spark, tmp_path):
    path = tmp_path / "s"
    frame = lambda rows: spark.createDataFrame(rows, "id string, v int, lane string")
    first = frame([(f"r{i}", i, "abc"[i % 3]) for i in range(30)] + [("none", None, None)])
    done = state.upsert(str(path), first, ["id"], ["lane"])
    assert (done.inserted, done.updated, done.unchanged, len(done.rewritten)) == (31, 0, 0, 4)
    was = files(path)
    again = state.upsert(str(path), first, ["id"], ["lane"])
    assert (again.inserted, again.updated, again.unchanged, again.rewritten) == (0, 0, 31, ()) and files(path) == was
    one = state.upsert(str(path), frame([("r3", 99, "a"), ("r4", 4, "b")]), ["id"], ["lane"])
    assert (one.updated, one.unchanged, one.rewritten) == (1, 1, (("a",),))
    assert {f for f, t in files(path).items() if was.get(f) != t} and all("lane=a" in f for f, t in files(path).items() if was.get(f) != t)
    moved = state.upsert(str(path), frame([("r5", 5, "d"), ("none", 1, None)]), ["id"], ["lane"])
    assert (moved.inserted, moved.updated) == (0, 2) and set(moved.rewritten) == {("c",), ("d",), (None,)}
    gone = state.upsert(str(path), frame([]), ["id"], ["lane"], frame([("r5", 0, "")]).unionByName(frame([("nobody", 0, "")])))
    assert gone.deleted == 1 and gone.rewritten == (("d",),) and not [f for f in files(path) if "lane=d" in f]
    expected = [(f"r{i}", 99 if i == 3 else i, "abc"[i % 3]) for i in range(30) if i != 5] + [("none", 1, None)]
    assert content(spark, path, first.schema) == sorted(expected, key=repr)
    for bad in ([("r1", 1, "a"), ("r1", 2, "b")],):
        with pytest.raises(InputError):
            state.upsert(str(path), frame(bad), ["id"], ["lane"])
    with pytest.raises(InputError):
        state.upsert(str(path), frame([("r1", 1, "b")]), ["id"], ["lane"], frame([("r1", 1, "b")]))


def test_judgments_rewrite_one_bucket(spark, tmp_path):
    path = str(tmp_path / "j")
    rows = spark.createDataFrame([(f"r{i}", "approved") for i in range(300)], "id string, status string")
    assert state.judged(path, rows, 8).inserted == 300
    done = state.judged(path, spark.createDataFrame([("r7", "rejected"), ("r8", "approved")], "id string, status string"), 8)
    assert (done.updated, done.unchanged, len(done.rewritten)) == (1, 1, 1)
    assert spark.read.parquet(path).where("status = 'rejected'").count() == 1 and spark.read.parquet(path).count() == 300


PLAN = builds.BuildPlan('{"a": 1}', "fp", {"ship": {"lane": "hull"}, "relic": {"field": "lane"}}, {"ship": ["name"]}, "style x", buckets=4)


def entries(spark, **changes):
    rows = []
    for i in range(40):
        kind = "ship" if i % 2 else "relic"
        entry = {"name": f"n{i}", "lane": "tool" if i % 4 else "hall", "freeze": {"status": "frozen" if i % 10 == 1 else "auto"}} | changes.get(f"e{i}", {})
        if changes.get(f"e{i}") != {}:
            rows.append((f"e{i}", kind, json.dumps(entry), json.dumps(entry), changes.get("version", "v1")))
    return spark.createDataFrame(rows, ENTRY).repartition(3)


def test_builds_in_a_row(spark, tmp_path):
    root, rows = str(tmp_path), lambda: {r["entity_id"]: r for r in builds.rows(spark, root).collect()}
    assert builds.run(entries(spark), root, PLAN, "g0", dry_run=True).entities_rebuilt == 40 and not files(tmp_path)
    first = builds.run(entries(spark), root, PLAN, "g1")
    assert (first.entities_total, first.entities_rebuilt, first.entities_cached, first.frozen_entries, first.drifted) == (40, 40, 0, 4, ())
    was = files(tmp_path / "rows")
    second = builds.run(entries(spark), root, PLAN, "g2")
    assert (second.entities_rebuilt, second.entities_cached, second.rewritten) == (0, 40, ()) and files(tmp_path / "rows") == was
    # one changed entry: one partition, and drift of a frozen one
    third = builds.run(entries(spark, e11={"name": "new"}), root, PLAN, "g3")
    assert (third.entities_rebuilt, third.drifted, len(third.rewritten)) == (1, (("e11", "frozen"),), 1)
    changed = {f for f, t in files(tmp_path / "rows").items() if was.get(f) != t}
    assert changed and len({f.rpartition("/")[0] for f in changed}) == 1
    # back again: its old rendering is in the cache
    back = builds.run(entries(spark), root, PLAN, "g4")
    assert (back.entities_rebuilt, back.entities_cached, back.drifted) == (0, 40, (("e11", "frozen"),))
    # a lane that changes moves the row; an entry that is gone goes
    moved = builds.run(entries(spark, e2={"lane": "attic"}, e4={}), root, PLAN, "g5")
    assert moved.removed == 1 and rows()["e2"]["lane"] == "attic" and "e4" not in rows() and len(rows()) == 39
    # only: the rest stays, whatever is in the input
    some = builds.run(entries(spark, e6={"name": "six"}, e8={"name": "eight"}, e4={}), root, PLAN, "g6", only=spark.createDataFrame([("e6",)], "id string"))
    assert (some.entities_total, some.entities_rebuilt, some.removed) == (1, 1, 0) and len(rows()) == 39
    assert builds.latest(spark, root)["generated_from"] == "g6"


def test_all_drifted_entries_are_counted_and_kept(spark, tmp_path):
    root = str(tmp_path)
    frozen = lambda name: spark.range(1200).select(F.concat(F.lit("f"), "id").alias("id"), F.lit("ship").alias("schema_kind"), F.lit(f'{{"name": "{name}", "freeze": {{"status": "frozen"}}}}').alias("entry"), F.lit(name).alias("source"), F.lit("v1").alias("schema_version"))
    assert builds.run(frozen("old"), root, PLAN, "g1").drifted_entries == 0 and builds.drift(spark, root).count() == 0
    assert builds.run(frozen("new"), root, PLAN, "g2", dry_run=True).drifted_entries == 1200
    done = builds.run(frozen("new"), root, PLAN, "g2")
    assert (done.drifted_entries, builds.latest(spark, root)["stats"]["drifted_entries"]) == (1200, 1200)
    assert sorted(map(tuple, builds.drift(spark, root).collect())) == sorted((f"f{i}", "frozen") for i in range(1200))
    assert list(done.drifted) == sorted((f"f{i}", "frozen") for i in range(1200))[: builds.NAMED]


def test_full_builds(spark, tmp_path):
    root = str(tmp_path)
    builds.run(entries(spark), root, PLAN, "g1")
    assert builds.run(entries(spark), root, PLAN, "g2", full=True).entities_rebuilt == 40
    assert builds.run(entries(spark), root, PLAN, "g3", no_cache=True).entities_rebuilt == 40
    versions = builds.run(entries(spark, version="v2"), root, PLAN, "g4")
    assert versions.schema_change_full_rebuild and versions.entities_rebuilt == 40
    assert builds.run(entries(spark, version="v2"), root, PLAN, "g5").entities_rebuilt == 0


def test_a_build_that_fails_writes_nothing(spark, tmp_path):
    context = lambda e: e.select("id", F.when(F.col("id") == "e7", F.repeat(F.lit("x\n"), 300)).otherwise("x").alias("context"))
    with pytest.raises(InputError, match="e7"):
        builds.run(entries(spark), str(tmp_path), PLAN, "g", context=context)
    with pytest.raises(InputError, match="lane"):
        builds.run(entries(spark, e2={"lane": ""}), str(tmp_path), PLAN, "g")
    with pytest.raises(InputError, match="e1'"):
        builds.run(entries(spark).unionByName(entries(spark).where("id = 'e1'")), str(tmp_path), PLAN, "g")
    assert not files(tmp_path)


@pytest.mark.parametrize("n, fan", [(0, 4), (1, 4), (4, 4), (5, 4), (70, 4), (70, 256)])
def test_tree_hash(spark, n, fan):
    rows = [(f"d{i % 7}/{i:03}.md", f"text {i}".encode()) for i in range(n)] + [("d0/000.md", b"again")] * (n > 5)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    level = [h for _, h in sorted((p, sha(p.encode() + b"\0" + sha(c).encode())) for p, c in rows)]
    while len(level) > 1:
        level = [sha("\n".join(level[i : i + fan]).encode()) for i in range(0, len(level), fan)]
    for parts in (1, 5):
        got = canon.tree_hash(spark.createDataFrame(rows, "path string, content binary").repartition(parts), fan).collect()
        assert [r[0] for r in got] == ["content-sha:" + (level[0] if level else sha(b""))]
