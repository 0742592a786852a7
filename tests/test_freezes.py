"""Keyed state over the freeze log: the stream gives the rows of the batch, however it is cut and restarted."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest

from loomery.streaming import freezes

SCHEMA = "entity_id string, event_time timestamp, type string, new_status string"
START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def stamp(hours):
    return (START + timedelta(hours=hours)).strftime("%Y-%m-%dT%H:%M:%SZ")


def events(seed):
    """Events of five entities, a minute apart at least, out of order by less than the watermark's delay."""
    rng = random.Random(seed)
    rows = []
    for i in range(120):
        kind = rng.choice(["freeze", "bypass", "unfreeze", "bypass"])
        status = {"freeze": rng.choice(["frozen", "soft-advisory"]), "unfreeze": "auto", "bypass": rng.choice([None, "frozen"])}[kind]
        rows.append((f"e{rng.randint(0, 4)}", i * 0.4 + rng.random() * 0.3, kind, status))
    return [(e, stamp(h), k, s) for e, h, k, s in sorted(rows, key=lambda r: r[1] + rng.random())]


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(key, was)


def rows_of(df):
    return sorted((r["entity_id"], r["at"], r["change"], r["status"], r["bypassed"]) for r in df.where("entity_id <> 'end'").collect())


def test_a_restarted_stream_gives_the_rows_of_the_batch(spark, rocks, tmp_path):
    (tmp_path / "in").mkdir()

    def put(name, rows):
        (tmp_path / "in" / f"{name}.json").write_text("".join(json.dumps(dict(zip(("entity_id", "event_time", "type", "new_status"), r))) + "\n" for r in rows))

    def run():
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        out = freezes.status_changes(source, 3, "2 hours").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
        out.trigger(availableNow=True).start().awaitTermination()

    log = events(1)
    put("a", log[:50])
    put("b", log[50:55])
    run()
    put("c", log[55:])
    run()
    put("d", [("end", stamp(500), "freeze", "frozen")])
    run()
    put("e", [("e1", stamp(1), "freeze", "frozen"), ("end", stamp(501), "freeze", "frozen")])  # far too late: left out
    run()
    batch = freezes.status_history(spark.createDataFrame([(e, datetime.strptime(h, "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc), k, s) for e, h, k, s in log], SCHEMA), 3)
    got = rows_of(spark.read.parquet(str(tmp_path / "out")))
    assert got == rows_of(batch) and any(r[2] == "bypass-ended" for r in got) and len(got) > len(log)


def plain(log, hours):
    out = []
    for entity in sorted({r[0] for r in log}):
        status, until = "auto", None
        own = sorted((datetime.strptime(h, "%Y-%m-%dT%H:%M:%SZ"), k, s or "") for e, h, k, s in log if e == entity)
        for at, kind, new in [*own, (datetime.max, "", "")]:
            if until and until <= at:
                out.append((entity, until, "bypass-ended", status, False))
                until = None
            if kind == "bypass":
                until = at + timedelta(hours=hours)
            elif kind:
                status = new or status
            if kind:
                out.append((entity, at, kind, status, until is not None and until > at))
    return sorted(out)


def test_history_against_one_event_at_a_time(spark):
    for seed in (2, 3):
        log = events(seed)
        df = spark.createDataFrame([(e, datetime.strptime(h, "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc), k, s) for e, h, k, s in log], SCHEMA)
        assert rows_of(freezes.status_history(df, 3)) == plain(log, 3)
