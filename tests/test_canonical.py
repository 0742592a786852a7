"""Canonical JSON as expressions, against the one value at a time."""

import json
import random
import struct

from pyspark.sql import functions as F

from loomery.functions import canonical as jvm
from loomery.operators import canon


def value(rng, depth=0):
    kind = rng.randint(0, 9 if depth < 4 else 6)
    if kind < 3:
        return rng.choice([0, 1, -1, 7, 10**15, 2**53 + 1, 10**20, 123456789012345678, 1.5, 1.0, -0.0, 1e21, 1e-7, 0.1 + 0.2, 1e23, 5e-324, 1.7976931348623157e308, 2.82879384806159e17, -123.456e-5, rng.random(), rng.uniform(-1e6, 1e6)])
    if kind < 6:
        return rng.choice(["", "a", "é 😀", 'quo"te \\ back/slash', "\u0001\u001f\n\t\b\f\r", "\\u001F 12.50 -3e5", "1.0", " \u007f", "x" * 300, "Infinity"])
    if kind == 6:
        return rng.choice([None, True, False])
    if kind == 7:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    keys = ["b", "a", "é", "A", "z.z", "דּ", "😀", "ffff", "a b", 'q"', "", "10", "9"]
    return {k: value(rng, depth + 1) for k in rng.sample(keys, rng.randint(0, 5))}


def test_canonical(spark):
    rng = random.Random(1)
    values = [value(rng) for _ in range(400)]
    texts = [json.dumps(v, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2])) for v in values]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", jvm.canonical(F.col("t")).alias("c")).collect()
    for r in rows:
        assert r["c"] == canon.canonical(json.loads(texts[r["i"]])), texts[r["i"]]
    bad = spark.createDataFrame([("{",), ("",), (None,), ("[1,]",)], "t string").select(jvm.canonical(F.col("t")).alias("c"))
    assert [r["c"] for r in bad.collect()] == [None] * 4


def test_number_texts(spark):
    rng = random.Random(2)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)] + [rng.choice([1, -1]) * round(rng.random(), d) * 10.0**e for d in range(1, 17) for e in range(-12, 26)]
    values += [10.0**e for e in range(-323, 309)] + [float("inf"), float("nan"), 0.0, -0.0]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v double").select("i", jvm.number_text(F.col("v")).alias("t")).collect()
    assert [(values[r["i"]], r["t"]) for r in rows if r["t"] != canon.number_text(values[r["i"]])] == []


def test_watch_hash(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        entry = {"name": value(rng, 2), "visual": {"cue": value(rng, 2), "deep": {"x": value(rng, 3), "a b": 1.50}}, "list": [1, {"x": 2}], "freeze": {"status": "frozen"}, "😀": 1, "דּ": 2}
        fields = rng.sample(["name", "visual.cue", "visual.deep.x", "visual.deep.a b", "list.x", "list", "none", "visual.none.x", "name.x", "😀", "דּ", "freeze"], rng.randint(0, 6))
        rows.append((i, json.dumps(entry), fields + fields[:1], rng.choice(["v1", 'v"2', None])))
    frame = spark.createDataFrame(rows, "i int, entry string, fields array<string>, version string")
    got = {r["i"]: r["h"] for r in frame.select("i", jvm.watch_hash(F.col("entry"), F.col("fields"), F.col("version")).alias("h")).collect()}
    assert got == {i: canon.watch_hash(json.loads(e), f, v) for i, e, f, v in rows}
    none = spark.createDataFrame([(None, None, "v")], "e string, f array<string>, v string").select(jvm.watch_hash(F.col("e"), F.col("f"), F.col("v")).alias("h")).first()
    assert none["h"] == canon.watch_hash({}, [], "v")
