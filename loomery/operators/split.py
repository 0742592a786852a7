"""Leakage-free train, val and test split by family, stratified by lane and seeded."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from loomery.config import SplitProfile
from loomery.functions.prng import draw
from loomery.operators.numbering import numbered
from loomery.sources.shared import checkpointed

PARTS = ("train", "val", "test")


def allocate(total: int, profile: SplitProfile) -> tuple[int, int, int]:
    """Largest remainders; with three or more every part gets one, from the largest other."""
    if total <= 0:
        return 0, 0, 0
    ideal = {"train": total * profile.train_ratio, "val": total * profile.val_ratio, "test": total * profile.test_ratio}
    counts = {p: int(v // 1) for p, v in ideal.items()}
    order = sorted(PARTS, key=lambda p: (-(ideal[p] - counts[p]), p))
    for i in range(total - sum(counts.values())):
        counts[order[i % 3]] += 1
    for p in PARTS if total >= 3 else ():
        donors = [q for q in PARTS if q != p and counts[q] > 1]
        if counts[p] == 0 and donors:
            counts[min(donors, key=lambda q: (-counts[q], q))] -= 1
            counts[p] += 1
    return counts["train"], counts["val"], counts["test"]


def majority_lane(members: DataFrame) -> DataFrame:
    """(family, lane, chosen_count, record_count): most records, then the first name."""
    counts = members.groupBy("family", "lane").agg(F.count("*").alias("n"))
    # a maximum over structs: no sort of a family's rows, and partial sums do most of it
    best = F.min(F.struct((-F.col("n")).alias("less"), "lane"))
    picked = counts.groupBy("family").agg(best.alias("best"), F.sum("n").alias("record_count"))
    return picked.select("family", F.col("best.lane").alias("lane"), (-F.col("best.less")).alias("chosen_count"), "record_count")


def lane_plan(chosen: DataFrame) -> DataFrame:
    """(lane, families, first_draw): lanes share one stream of draws, in order of their names.

    The running sum is over lanes, whose number is set by configuration.
    """
    sizes = chosen.groupBy("lane").agg(F.count("*").alias("families"))
    before = Window.partitionBy(F.lit(0)).orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    used = F.greatest(F.col("families") - 1, F.lit(0))
    return sizes.select("lane", "families", (F.coalesce(F.sum(used).over(before), F.lit(0)) + 1).alias("first_draw"))


def allocation(sizes: DataFrame, profile: SplitProfile, total: str = "families") -> DataFrame:
    """``sizes`` with train, val and test: ``allocate`` of the column ``total`` for every row."""
    n = F.col(total)
    ratio = {"train": profile.train_ratio, "val": profile.val_ratio, "test": profile.test_ratio}
    out = sizes.withColumns({p: F.when(n > 0, F.floor(n * F.lit(ratio[p]))).otherwise(0).cast("bigint") for p in PARTS})
    rest = {p: n * F.lit(ratio[p]) - F.col(p) for p in PARTS}
    spare = n - sum((F.col(p) for p in PARTS), F.lit(0))
    ahead = {p: sum(((rest[q] > rest[p]) | ((rest[q] == rest[p]) & F.lit(q < p))).cast("int") for q in PARTS if q != p) for p in PARTS}
    out = out.withColumns({p: F.when(n > 0, F.col(p) + F.greatest(F.lit(0), F.floor((spare - ahead[p] + 2) / 3))).otherwise(0).cast("bigint") for p in PARTS})
    for p in PARTS:
        # the largest other part with more than one gives
        donors = [F.when(F.col(q) > 1, F.struct((-F.col(q)).alias("less"), F.lit(q).alias("part"))) for q in PARTS if q != p]
        giver = F.when((n >= 3) & (F.col(p) == 0), F.least(*donors)["part"])
        given = out.withColumn("_giver", giver)
        out = given.withColumns({q: F.col(q) + F.when(F.col("_giver").isNull(), 0).when(F.lit(q == p), 1).when(F.col("_giver") == q, -1).otherwise(0) for q in PARTS}).drop("_giver")
    return out


def replayed(steps: DataFrame) -> DataFrame:
    """(lane, position, source): which item ends up where when all swaps are done.

    ``steps`` has lane, i and target for each place i of a lane: swaps run from the
    highest i down, each with its target at or below it (place 0 has itself). A place is final once its swap is
    done: it then holds what its target held just before. A place's content comes from its last writer, the
    least later i with that target, and that one's from its own last writer, so
    contents are roots of a forest, found by pointer doubling over all swaps at once. Its depth, and so the rounds, grow with
    the logarithm of the places.
    """
    same_target = Window.partitionBy("lane", "target").orderBy("i")
    planned = checkpointed(steps.select("lane", "i", "target", F.lead("i").over(same_target).alias("writer")))
    now = planned.groupBy("lane", F.col("target").alias("place")).agg(F.min(F.when(F.col("i") > F.col("target"), F.col("i"))).alias("root")).where("root is not null")
    now = checkpointed(now)
    while True:
        ahead = now.select("lane", F.col("place").alias("root"), F.col("root").alias("ahead"))
        stepped = checkpointed(now.join(ahead, ["lane", "root"], "left").select("lane", "place", F.coalesce("ahead", "root").alias("root"), F.expr("ahead is not null").alias("moved")))
        now = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            break
    held = now.select("lane", F.col("place").alias("writer"), "root")
    return planned.join(held, ["lane", "writer"], "left").select("lane", F.col("i").alias("position"), F.coalesce("root", "writer", "target").alias("source"))


def assign_families(chosen: DataFrame, profile: SplitProfile) -> DataFrame:
    """(family, lane, position, part): each lane's families in the seeded order, the first to train, the next to val, the rest to test.

    No task holds a lane: families are numbered by ranges, draws are functions of
    their number, and the swaps are replayed in parallel. Under three families all go to train. Lanes are those of the
    configuration, so their plan is broadcast.
    """
    few = {p: F.when(F.col("families") < 3, F.col("families") if p == "train" else 0).otherwise(F.col(p)) for p in PARTS}
    plan = allocation(lane_plan(chosen), profile).withColumns(few)
    names = checkpointed(numbered(chosen.select("lane", "family"), ["family"], ["lane"], "i"))
    u = draw(profile.seed, F.col("first_draw") + F.col("families") - 1 - F.col("i"))
    target = F.when(F.col("i") == 0, 0).otherwise(F.floor(u * (F.col("i") + 1))).cast("bigint")
    steps = names.join(F.broadcast(plan.select("lane", "families", "first_draw")), "lane").select("lane", "i", target.alias("target"))
    placed = replayed(steps).join(F.broadcast(plan.select("lane", "train", "val")), "lane")
    part = F.when(F.col("position") < F.col("train"), PARTS[0]).when(F.col("position") < F.col("train") + F.col("val"), PARTS[1]).otherwise(PARTS[2])
    return placed.join(names.withColumnRenamed("i", "source"), ["lane", "source"]).select("family", "lane", "position", part.alias("part"))


def create(members: DataFrame, profile: SplitProfile) -> DataFrame:
    """record_id, family, lane (the family's), part, for members (id, family, lane)."""
    assigned = assign_families(majority_lane(members), profile)
    return members.select(F.col("id").alias("record_id"), "family").join(assigned.select("family", "lane", "part"), "family").select("record_id", "family", "lane", "part")


def leakage(assigned: DataFrame, by: str = "family") -> DataFrame:
    """Groups that are in more than one part; ``by`` the subject it is an audit that family assignment can't hide from."""
    spread = assigned.where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("record_count"), F.array_join(F.sort_array(F.collect_set("part")), ",").alias("leaked_to"), F.count_distinct("part").alias("parts"))
    return spread.where("parts > 1").select(by, "record_count", "leaked_to")


def lane_balance(assigned: DataFrame, profile: SplitProfile) -> DataFrame:
    """Per lane of the records: counts, percentages (one decimal) and absolute deviation from the ratios."""
    counts = assigned.groupBy("lane").agg(F.count("*").alias("total"), *(F.count_if(F.col("part") == p).alias(p) for p in PARTS))
    percent = {p: F.round(F.col(p) * 100.0 / F.col("total"), 1) for p in PARTS}
    target = {"train": profile.train_ratio, "val": profile.val_ratio, "test": profile.test_ratio}
    away = sum((F.abs(percent[p] - F.lit(target[p] * 100)) for p in PARTS), F.lit(0.0))
    return counts.select("lane", "total", *PARTS, *(v.alias(f"{p}_pct") for p, v in percent.items()), F.round(away, 1).alias("deviation"))


def balance_summary(balance: DataFrame) -> DataFrame:
    """One row: the sum of deviations and the worst lane. A relation of its own, not a row among the lanes."""
    return balance.agg(F.round(F.sum("deviation"), 1).alias("overall_deviation"), F.min(F.struct(-F.col("deviation"), "lane"))["lane"].alias("worst_lane"))
