"""Line numbers of files that are read in many blocks."""

import json
import random

import pytest

from loomery.config import InputError
from loomery.schema import ROW_SCHEMA_VERSION
from loomery.sources import lines


@pytest.fixture
def small_blocks(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k, v in zip(was, ("700", "16")):
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def row(i, rng, version=ROW_SCHEMA_VERSION):
    return json.dumps({"schema_version": version, "id": i, "text": "é" * rng.randint(0, 90)}, ensure_ascii=False)


def test_numbers(spark, tmp_path, small_blocks):
    rng, wanted = random.Random(1), {}
    for name, n in (("a", 400), ("b", 1), ("c", 90), ("empty", 0)):
        made = [rng.choice(["", "  ", row(i, rng), "x" * rng.randint(1, 3000)]) for i in range(n)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(made) + ("\n" if n and name != "c" else ""))
        wanted |= {(name, i + 1): line for i, line in enumerate(made)}
    if not wanted["c", 90]:  # a last empty line without a line feed is none
        del wanted["c", 90]
    got = lines.numbered(spark, str(tmp_path))
    assert {(r["file"].rpartition("/")[2][:-6], r["line"]): r["value"] for r in got.collect()} == wanted
    assert got.rdd.getNumPartitions() > 20
    # filters that come later don't change the numbers
    some = {(r["line"], r["value"]) for r in got.where("file like '%/c.jsonl' and line > 40").collect()}
    assert some == {(n, v) for (f, n), v in wanted.items() if f == "c" and n > 40}


def test_the_first_wrong_line_is_named(spark, tmp_path, small_blocks):
    rng = random.Random(2)
    made = [row(i, rng) for i in range(500)]
    made[3] = "  "
    path = tmp_path / "rows.jsonl"
    path.write_text("\n".join(made))
    ddl = "schema_version string, id int, text string"
    good = lines.strict_rows(spark, str(path), ddl)
    assert good.count() == 499 and {r["line"] - 1 - r["id"] for r in good.collect()} == {0}
    for at, bad, said in ((477, made[477][:-1], "not valid JSON"), (431, row(431, rng, "0.1"), "has schema_version 0.1"), (430, "123", "has schema_version none")):
        made[at] = bad
        path.write_text("\n".join(made))
        with pytest.raises(InputError, match=f"line {at + 1} of .*rows.jsonl: {said}"):
            lines.strict_rows(spark, str(path), ddl)
    assert [r["line"] for r in lines.problems(lines.numbered(spark, str(path))).orderBy("line").collect()] == [431, 432, 478]
