"""The seeded split replayed in parallel, against swaps one by one."""

import random

import pytest
from pyspark.sql import functions as F

from loomery.config import SplitProfile
from loomery.functions.prng import shuffled
from loomery.operators import numbering, split


def plain(chosen, profile):
    lanes, used, out = {}, 0, {}
    for family, lane in chosen:
        lanes.setdefault(lane, []).append(family)
    for lane in sorted(lanes):
        order = shuffled(sorted(lanes[lane]), profile.seed, used + 1)
        used += max(len(order) - 1, 0)
        train, val, _ = split.allocate(len(order), profile) if len(order) >= 3 else (len(order), 0, 0)
        out |= {f: (lane, i, "train" if i < train else "val" if i < train + val else "test") for i, f in enumerate(order)}
    return out


@pytest.mark.parametrize("seed", [0, 42])
def test_replay_is_the_sequential_shuffle(spark, seed):
    sizes = {"one": 1, "two": 2, "three": 3, "few": 17, "more": 400, "most": 6000}
    names = [f"f{i:05}" for i in range(6000)]
    chosen = [(random.Random(seed).choice("xyz") + n if lane == "few" else n + lane, lane) for lane, size in sizes.items() for n in names[:size]]
    random.Random(1).shuffle(chosen)
    profile = SplitProfile("p", 0.7, 0.2, 0.1, seed)
    got = split.assign_families(spark.createDataFrame(chosen, "family string, lane string").repartition(5), profile)
    assert {r["family"]: (r["lane"], r["position"], r["part"]) for r in got.collect()} == plain(chosen, profile)


def test_replay_of_a_long_lane(spark):
    n = 100_000
    steps = spark.range(n).select(F.lit("l").alias("lane"), F.col("id").alias("i"), F.when(F.col("id") == 0, 0).otherwise(F.floor(split.draw(9, n - F.col("id")) * (F.col("id") + 1))).alias("target"))
    got = [r["source"] for r in split.replayed(steps).orderBy("position").select("source").collect()]
    assert got == shuffled(list(range(n)), 9, 1)


def test_replay_of_chains(spark):
    """Targets that make one long chain of writers, and none at all."""
    for targets in ([0] + [i - 1 for i in range(1, 300)], list(range(300)), [0] * 300):
        plainly = list(range(300))
        for i in range(299, 0, -1):
            j = targets[i]
            plainly[i], plainly[j] = plainly[j], plainly[i]
        rows = spark.createDataFrame([("l", i, j) for i, j in enumerate(targets)], "lane string, i long, target long")
        assert [r["source"] for r in split.replayed(rows).orderBy("position").collect()] == plainly


@pytest.mark.parametrize("ratios", [(0.8, 0.1, 0.1), (0.95, 0.04, 0.01), (1 / 3, 1 / 3, 1 / 3), (0.5, 0.5, 0.0), (0.0, 0.0, 1.0)])
def test_allocation_as_columns(spark, ratios):
    profile = SplitProfile("p", *ratios)
    got = split.allocation(spark.range(-1, 200).withColumnRenamed("id", "families"), profile).collect()
    assert {r["families"]: (r["train"], r["val"], r["test"]) for r in got} == {n: split.allocate(n, profile) for n in range(-1, 200)}


def test_numbered(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.randint(0, 10**6), "x") for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, v long, index_ string").repartition(7)
    got = numbering.numbered(df, ["v"], ["g"]).collect()
    for g in ("a", "b", None, "hot"):
        own = sorted((r["index"], r["v"]) for r in got if r["g"] == g)
        assert [i for i, _ in own] == list(range(len(own))) and [v for _, v in own] == sorted(v for _, v in own)
    whole = sorted((r["n"], r["v"]) for r in numbering.numbered(df, ["v"], name="n").collect())
    assert [i for i, _ in whole] == list(range(3000)) and [v for _, v in whole] == sorted(v for _, v in whole)
    assert numbering.numbered(df.limit(0), ["v"]).count() == 0


def test_no_families(spark):
    assert split.assign_families(spark.createDataFrame([], "family string, lane string"), SplitProfile("p", 0.8, 0.1, 0.1)).count() == 0
