"""Ids claimed by many at once, and runs that are killed and resumed."""

import collections
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest

from loomery.config import InputError
from loomery.sources import claims


def test_eight_threads_claim_without_gap_or_repeat(spark, tmp_path):
    counts = [(i * 7) % 5 + 1 for i in range(80)]
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda n: claims.claim(spark, str(tmp_path / "c"), "selection_2026-01-01_", n), counts))
    assert [len(g) for g in got] == counts
    ids = [i for g in got for i in g]
    assert sorted(ids) == [f"selection_2026-01-01_{n:03}" for n in range(1, sum(counts) + 1)] and sum(counts) >= 200
    for g in got:  # each claim is one range
        numbers = [int(i[-3:]) for i in g]
        assert numbers == list(range(numbers[0], numbers[0] + len(g)))
    assert not list((tmp_path / "c").glob(".*partial"))


def test_prefixes_and_numbers_in_use(spark, tmp_path):
    at = lambda *a, **k: claims.claim(spark, str(tmp_path), *a, **k)
    assert at("a_", taken=41) == ["a_042"] and at("a_", 2, taken=99) == ["a_043", "a_044"]
    assert at("a_b_") == ["a_b_001"] and at("x.", width=1) == ["x.1"]
    with pytest.raises(InputError):
        at("a_", 0)


def test_create_if_absent(tmp_path):
    target, base = claims.opened(str(tmp_path))
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: claims.create_if_absent(target, f"{base}/d/x", b"%d" % i), range(100)))
    assert sum(made) == 1 and (tmp_path / "d/x").read_bytes() == b"%d" % made.index(True) and len(list((tmp_path / "d").iterdir())) == 1


def runner(log, dies=(), fails=()):
    """Notes each slot it runs; ends its whole process at slots in ``dies``, so that the job is lost as with a machine."""

    def work(row):
        import os

        if row["slot_id"] in dies and not Path(log, f"died-{row['n']}").exists():
            Path(log, f"died-{row['n']}").touch()
            os._exit(1)
        with open(f"{log}/ran-{row['n']}", "a") as f:
            f.write("x")
        if row["slot_id"] in fails:
            raise ValueError("no image")
        return f"out/{row['slot_id']}.png"

    return work


def ran(log):
    return collections.Counter({int(p.name[4:]): len(p.read_text()) for p in Path(log).glob("ran-*")})


def test_a_killed_run_resumes_with_the_same_rows(spark, tmp_path):
    log, folder = str(tmp_path / "log"), str(tmp_path / "run")
    Path(log).mkdir()
    planned = spark.createDataFrame([(f"slot {i}/é" if i % 2 else f"slot-{i}", i) for i in range(40)], "slot_id string, n int").repartition(4, "n")
    with pytest.raises(Exception):
        claims.run_slots(planned, folder, runner(log, dies=("slot-20",)))
    ended = {r["slot_id"] for r in claims.states(spark, folder).collect()}
    assert "slot-20" not in ended
    before = ran(log)
    got = claims.run_slots(planned, folder, runner(log))
    rows = {r["slot_id"]: (r["status"], r["output"]) for r in got.collect()}
    assert rows == {f"slot {i}/é" if i % 2 else f"slot-{i}": ("ok", f"out/{'slot ' + str(i) + '/é' if i % 2 else 'slot-' + str(i)}.png") for i in range(40)}
    after = ran(log)
    name = lambda i: f"slot {i}/é" if i % 2 else f"slot-{i}"
    assert all(after[i] == before[i] for i in range(40) if name(i) in ended) and all(after[i] >= 1 for i in range(40))
    assert claims.run_slots(planned, folder, runner(log)).count() == 40 and ran(log) == after


def test_failed_slots_run_again(spark, tmp_path):
    log, folder = str(tmp_path / "log"), str(tmp_path / "run")
    Path(log).mkdir()
    planned = spark.createDataFrame([(f"s{i}", i) for i in range(6)], "slot_id string, n int")
    first = {r["slot_id"]: (r["status"], r["error"]) for r in claims.run_slots(planned, folder, runner(log, fails=("s2", "s4"))).collect()}
    assert first["s2"] == ("failed", "ValueError: no image") and first["s1"] == ("ok", None)
    assert {r["status"] for r in claims.run_slots(planned, folder, runner(log), retry=()).where("slot_id in ('s2', 's4')").collect()} == {"failed"}
    assert {r["status"] for r in claims.run_slots(planned, folder, runner(log)).collect()} == {"ok"} and ran(log) == {0: 1, 1: 1, 2: 2, 3: 1, 4: 2, 5: 1}
