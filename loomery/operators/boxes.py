"""Placement of boxes and points as relations: overlap by shared grid cells, placement in rounds of darts, label checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomery.sources.shared import checkpointed


def _in_cells(boxes: DataFrame, pad: int, cell: int) -> DataFrame:
    """Each box once for every grid cell that it touches with its padding."""
    span = lambda start, size: F.sequence(F.floor((F.col(start) - pad) / cell), F.floor((F.col(start) + F.col(size) + pad) / cell))
    return boxes.withColumn("cx", F.explode(span("x", "w"))).withColumn("cy", F.explode(span("y", "h")))


def _meet(pad: int) -> Column:
    """Whether the boxes of sides a and b, which share a cell of one image, overlap with padding."""
    c = F.col
    apart = [c(f"{p}.{at}") + c(f"{p}.{size}") + pad <= c(f"{q}.{at}") for at, size in (("x", "w"), ("y", "h")) for p, q in (("a", "b"), ("b", "a"))]
    same = [c(f"a.{n}") == c(f"b.{n}") for n in ("image", "cx", "cy")]
    return reduce(lambda x, y: x & y, same) & ~reduce(lambda x, y: x | y, apart)


def overlaps(boxes: DataFrame, pad: int = 0, cell: int = 256) -> DataFrame:
    """(image, a, b): pairs of boxes (image, box, x, y, w, h) of one image that overlap with padding.

    Boxes are entered in the grid cells they touch; only boxes that share a cell meet.
    """
    placed = _in_cells(boxes, pad, cell)
    pairs = placed.alias("a").join(placed.alias("b"), _meet(pad) & (F.col("a.box") < F.col("b.box")))
    return pairs.select(F.col("a.image").alias("image"), F.col("a.box").alias("a"), F.col("b.box").alias("b")).distinct()


def place(plans: DataFrame, pad: int = 2, tries: int = 200, block: int = 50, cell: int = 256) -> DataFrame:
    """Spots without overlap for boxes planned as (image, seed, width, height, ord, w, h): image, ord, x, y, w, h, placed.

    All boxes of all images are tried at once, in rounds. A box draws ``block`` spots, each
    a hash of its seed, its ord and the number of the draw; the first one free of what earlier rounds have placed is its offer. Of
    offers that overlap, the one of least ord is taken and the others draw on. A box that has drawn ``tries`` spots
    or is larger than its image stays unplaced, at 0, 0. No task holds an image; the same plans give the same spots.
    """
    given = checkpointed(plans.select("image", "seed", "width", "height", "ord", "w", "h"))
    fits = (F.col("w") < F.col("width")) & (F.col("h") < F.col("height"))
    spots = given.select("image", "ord", "w", "h", F.lit(0).alias("x"), F.lit(0).alias("y")).limit(0)
    waiting = given.where(fits).withColumn("drawn", F.lit(0))
    draw = lambda axis, room: F.pmod(F.xxhash64("seed", "image", "ord", "draw", F.lit(axis)), room + 1).cast("int")
    while True:
        drawn = waiting.withColumn("draw", F.explode(F.sequence(F.col("drawn"), F.least(F.col("drawn") + block, F.lit(tries)) - 1)))
        drawn = drawn.withColumns({"x": draw("x", F.col("width") - F.col("w")), "y": draw("y", F.col("height") - F.col("h"))})
        taken = _in_cells(drawn, pad, cell).alias("a").join(_in_cells(spots, pad, cell).alias("b"), _meet(pad)).select("a.image", "a.ord", "a.draw")
        free = drawn.join(taken, ["image", "ord", "draw"], "left_anti")
        offers = checkpointed(free.groupBy("image", "ord").agg(F.min(F.struct("draw", "x", "y", "w", "h")).alias("o")).select("image", "ord", "o.*"))
        entered = _in_cells(offers, pad, cell)
        lost = entered.alias("a").join(entered.alias("b"), _meet(pad) & (F.col("a.ord") < F.col("b.ord"))).select("b.image", "b.ord")
        won = offers.join(lost, ["image", "ord"], "left_anti").select("image", "ord", "w", "h", "x", "y")
        spots = checkpointed(spots.unionByName(won))
        # who had an offer draws on behind it, who had none behind the block
        behind = offers.select("image", "ord", (F.col("draw") + 1).alias("next"))
        waiting = waiting.join(spots, ["image", "ord"], "left_anti").join(behind, ["image", "ord"], "left")
        waiting = checkpointed(waiting.withColumn("drawn", F.coalesce("next", F.col("drawn") + block)).drop("next").where(F.col("drawn") < tries))
        if waiting.isEmpty():
            break
    found = spots.select("image", "ord", "x", "y", F.lit(True).alias("found"))
    out = given.join(found, ["image", "ord"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("int").alias(c)
    return out.select("image", F.col("ord").cast("int").alias("ord"), zero("x"), zero("y"), F.col("w").cast("int").alias("w"), F.col("h").cast("int").alias("h"), F.coalesce("found", F.lit(False)).alias("placed"))


def scatter(plans: DataFrame, darts: int = 12) -> DataFrame:
    """Points at least ``spacing`` apart in images planned as (image, seed, width, height, spacing): image, ord, x, y.

    Parallel dart throwing: every square of side ``spacing`` gets ``darts`` darts and each dart a priority, all by hashes.
    Darts too near each other exclude each other; in rounds, a dart that comes before all that exclude it and are still open
    is taken, and what it excludes goes. The points are those that taking darts one by one in order of priority would give, and no
    dart is left that would fit. Rounds grow with the logarithm of the darts.
    """
    uniform = lambda what: F.pmod(F.xxhash64("seed", "image", "cx", "cy", "dart", F.lit(what)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    cells = lambda size: F.sequence(F.lit(0), F.ceil(F.col(size) / F.col("spacing")).cast("int") - 1)
    thrown = plans.select("*", F.explode(cells("width")).alias("cx")).withColumn("cy", F.explode(cells("height"))).withColumn("dart", F.explode(F.sequence(F.lit(0), F.lit(darts - 1))))
    thrown = thrown.withColumns({"x": (F.col("cx") + uniform("x")) * F.col("spacing"), "y": (F.col("cy") + uniform("y")) * F.col("spacing"), "first": uniform("order")})
    inside = (F.col("x") < F.col("width")) & (F.col("y") < F.col("height"))
    dart = F.struct("first", "cx", "cy", "dart").alias("p")
    open_ = checkpointed(thrown.where(inside).select("image", dart, "x", "y", "cx", "cy", "spacing"))
    steps = F.array(*(F.lit(i) for i in (-1, 0, 1)))
    around = open_.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps)).withColumns({"cx": F.col("cx") + F.col("dx"), "cy": F.col("cy") + F.col("dy")})
    a, b, c = open_.alias("a"), around.alias("b"), F.col
    near = (c("a.image") == c("b.image")) & (c("a.cx") == c("b.cx")) & (c("a.cy") == c("b.cy")) & (c("a.p") != c("b.p"))
    near &= F.pow(c("a.x") - c("b.x"), 2) + F.pow(c("a.y") - c("b.y"), 2) < F.pow(c("a.spacing"), 2)
    # both directions of each pair
    excludes = checkpointed(a.join(b, near).select(c("a.image").alias("image"), c("a.p").alias("p"), c("b.p").alias("q")))
    points, left = None, open_.select("image", "p", "x", "y")
    while True:
        before = excludes.where("q < p").select("image", "p").distinct()
        won = checkpointed(left.join(before, ["image", "p"], "left_anti"))
        points = won if points is None else points.unionByName(won)
        gone = excludes.join(won.select("image", F.col("p").alias("q")), ["image", "q"], "left_semi").select("image", "p").unionByName(won.select("image", "p")).distinct()
        left = checkpointed(left.join(gone, ["image", "p"], "left_anti"))
        if left.isEmpty():
            break
        excludes = checkpointed(excludes.join(gone, ["image", "p"], "left_anti").join(gone.select("image", F.col("p").alias("q")), ["image", "q"], "left_anti"))
    order = Window.partitionBy("image").orderBy("p")
    return points.select("image", (F.row_number().over(order) - 1).cast("int").alias("ord"), "x", "y")


def miscounted(labels: DataFrame) -> DataFrame:
    """Labels whose count isn't their number of boxes."""
    n = F.coalesce(F.size("bboxes_xywh"), F.lit(0))
    return labels.where(F.col("count") != n).select("image", "count", n.alias("boxes"))
