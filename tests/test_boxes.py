"""Placement in rounds: no overlap, nothing left that fits, the same again."""

import math
import random

from loomery.operators import boxes

PLAN = "image string, seed int, width int, height int, ord int, w int, h int"


def spots(df):
    return {(r["image"], r["ord"]): (r["x"], r["y"], r["w"], r["h"]) for r in df.collect() if r["placed"]}


def test_places(spark):
    rng = random.Random(1)
    rows = [(f"i{i}", i, 600, 400, k, rng.randint(20, 120), rng.randint(20, 90)) for i in range(12) for k in range(10)]
    rows += [("big", 1, 50, 50, 0, 50, 10), ("big", 1, 50, 50, 1, 10, 10)] + [("full", 1, 100, 100, k, 60, 60) for k in range(3)]
    df = spark.createDataFrame(rows, PLAN)
    placed = boxes.place(df.repartition(4), pad=2)
    found = spots(placed)
    assert placed.count() == len(rows) and spots(boxes.place(df.repartition(2), pad=2)) == found
    for (image, k), (x, y, w, h) in found.items():
        width, height = (600, 400) if image[0] == "i" else (50, 50) if image == "big" else (100, 100)
        assert 0 <= x <= width - w and 0 <= y <= height - h
        for (other, j), (x2, y2, w2, h2) in found.items():
            if other == image and j != k:
                assert x + w + 2 <= x2 or x2 + w2 + 2 <= x or y + h + 2 <= y2 or y2 + h2 + 2 <= y
    # all that a plane has room for, one of three that exclude each other, none of those too large
    assert sum(i[0] == "i" for i, _ in found) == 120 and [k for i, k in found if i == "full"] == [0] and [k for i, k in found if i == "big"] == [1]
    assert boxes.place(df.limit(0)).count() == 0


def test_scattered_points_are_those_of_darts_one_by_one(spark):
    plans = spark.createDataFrame([("a", 3, 100, 80, 12.0), ("b", 4, 50, 50, 60.0), ("c", 5, 30, 90, 7.5)], "image string, seed int, width int, height int, spacing double")
    got = {}
    for r in boxes.scatter(plans).orderBy("image", "ord").collect():
        got.setdefault(r["image"], []).append((r["x"], r["y"]))
    for image, width, height, gap in (("a", 100, 80, 12.0), ("b", 50, 50, 60.0), ("c", 30, 90, 7.5)):
        points = got[image]
        assert all(0 <= x < width and 0 <= y < height for x, y in points)
        assert all(math.dist(p, q) >= gap for i, p in enumerate(points) for q in points[:i])
        # most of the plane is within the spacing of a point
        grid = [(x, y) for x in range(width) for y in range(height)]
        assert sum(min(math.dist(p, g) for p in points) < gap for g in grid) > 0.97 * len(grid)
    assert len(got["a"]) > 30 and 1 <= len(got["b"]) <= 2
