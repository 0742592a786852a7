"""Embedding near-dedup by dual traversal of cover trees.

Distance is the angle between vectors, a metric. Equal vectors fall together
first and count with their number. Cells give the top of the tree: a bounded sample
of each cell that is too large gives it pivots, round after round, until cells are
small enough or ``most_pivots`` are used; every vector goes down to the cell of its
nearest pivots. Each cell is a block, or several where it stays too large, and each
block builds a cover tree whose radii halve from level to level. Pairs of blocks that
the bounds of pivots and radii can't rule out meet in a task, where both trees are
walked together: a pair of nodes is pruned where even their nearest members are too
far apart, taken as a whole where even the farthest are near enough, and opened
otherwise. All children of a pair of nodes are compared at once, as products of
matrices in tiles. So every pair at the threshold or above counts, and a dense group
costs its nodes, not its pairs.

The samples only shape the cells. Where the data have no structure no bound can
prune, and pairs of blocks grow with the square of the vectors.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomery.llm.components import components
from loomery.llm.store import written

MARGIN = 1e-6
#: Points of a node that is not opened; centres tried at once; sides of a tile of products.
LEAF, BATCH, TALL, WIDE = 64, 256, 1024, 4096
#: Pairs of rows of two leaves that are compared one by one, together with those of other leaves; pairs of rows at once.
FEW, CHUNK = 256, 1 << 17


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


class CoverTree:
    """Nodes as flat arrays. A node covers the run [lo, hi) of ``order`` within ``radius`` of its centre.

    The children of a node are the nodes [kids, kids + n_kids). A node's own centre
    is the centre of its first child: levels are nested.
    """

    def __init__(self, points: np.ndarray, finest: float) -> None:
        n = len(points)
        order = np.arange(n)
        nodes: list[list[float]] = []  # centre, radius, lo, hi, kids, n_kids
        if n:
            nodes.append([0, float(angles(points, points[:1]).max()) if n > 1 else 0.0, 0, n, 0, 0])
        at = 0
        while at < len(nodes):
            centre, radius, lo, hi, *_ = nodes[at]
            if hi - lo > LEAF and radius > finest:
                reach = math.pi / 2 ** math.ceil(math.log2(math.pi / radius) + 1e-9)
                reach = reach if reach < radius else reach / 2
                members, groups = _covered(points, order[lo:hi], centre, reach)
                order[lo:hi] = members
                nodes[at][4:] = len(nodes), len(groups)
                nodes += [[c, r, lo + a, lo + b, 0, 0] for c, r, a, b in groups]
            at += 1
        columns = np.array(nodes, float).reshape(-1, 6).T
        self.order = order
        #: points in the order of the nodes' runs
        self.points = points[order]
        self.centres = points[columns[0].astype(np.int64)]
        self.radius = columns[1]
        self.lo, self.hi, self.kids, self.n_kids = columns[2:].astype(np.int64)


def _covered(points: np.ndarray, members: np.ndarray, centre: int, reach: float) -> tuple[np.ndarray, list[tuple[int, float, int, int]]]:
    """Members by group, and the groups (centre, radius, from, to): centres are more than ``reach`` apart, members within it."""
    rest = np.concatenate([[centre], members[members != centre]])
    least, runs, groups, done = math.cos(reach), [], [], 0
    while len(rest):
        tried = rest[:BATCH]
        cos = points[rest] @ points[tried].T
        near = cos >= least
        free, chosen = np.ones(len(tried), bool), []
        for k in range(len(tried)):
            if free[k]:
                chosen.append(k)
                free &= ~near[: len(tried), k]
                near[k, k] = True
        inside = near[:, chosen]
        held = np.flatnonzero(inside.any(axis=1))
        owner = inside[held].argmax(axis=1)
        owner[np.searchsorted(held, chosen)] = np.arange(len(chosen))
        by_owner = np.argsort(owner, kind="stable")
        held, owner = held[by_owner], owner[by_owner]
        starts = np.searchsorted(owner, np.arange(len(chosen)))
        lowest = np.minimum.reduceat(cos[held, np.array(chosen)[owner]], starts)
        ends = np.append(starts[1:], len(held))
        radii = np.where(ends - starts > 1, np.arccos(np.clip(lowest, -1.0, 1.0)), 0.0)
        groups += [(int(tried[c]), r, done + a, done + b) for c, r, a, b in zip(chosen, radii.tolist(), starts.tolist(), ends.tolist())]
        runs.append(rest[held])
        done += len(held)
        left = np.ones(len(rest), bool)
        left[held] = False
        rest = rest[left]
    return np.concatenate(runs), groups


class Tally:
    """Weighted links and a union-find over the rows of one or two blocks."""

    def __init__(self, n: int) -> None:
        self.extra, self.steps, self.up = np.zeros(n), np.zeros(n + 1), list(range(n))

    @property
    def links(self) -> np.ndarray:
        return self.extra + np.cumsum(self.steps[:-1])

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)

    def add_run(self, lo: int, hi: int, weight: float) -> None:
        """``weight`` more links for each row of a run."""
        self.steps[lo] += weight
        self.steps[hi] -= weight

    def add_pairs(self, x: np.ndarray, y: np.ndarray, wx: np.ndarray, wy: np.ndarray) -> None:
        """One link for each pair of rows."""
        np.add.at(self.extra, x, wy)
        np.add.at(self.extra, y, wx)
        if len(x) > 500:
            roots = self.roots()
            apart = np.unique(np.stack([roots[x], roots[y]])[:, roots[x] != roots[y]], axis=1)
            x, y = apart
        for i, j in zip(x.tolist(), y.tolist()):
            self.join(i, j)

    def roots(self) -> np.ndarray:
        """Root of every row; all rows then point at theirs."""
        up = np.array(self.up)
        while (up != (further := up[up])).any():
            up = further
        self.up = up.tolist()
        return up

    def add_tile(self, x: np.ndarray, y: np.ndarray, wx: np.ndarray, wy: np.ndarray, hit: np.ndarray) -> None:
        """Links of the rows x with the rows y where ``hit`` is true."""
        n = np.count_nonzero(hit)
        if not n:
            return
        if n <= 2 * (len(x) + len(y)):
            p, q = np.nonzero(hit)
            self.add_pairs(x[p], y[q], wx[p], wy[q])
            return
        dense = hit.astype(np.float64)
        self.extra[x] += dense @ wy
        self.extra[y] += wx @ dense
        while True:  # one link a row and a column, then those that still join different groups
            for p in np.flatnonzero(hit.any(axis=1)).tolist():
                self.join(int(x[p]), int(y[hit[p].argmax()]))
            for q in np.flatnonzero(hit.any(axis=0)).tolist():
                self.join(int(x[hit[:, q].argmax()]), int(y[q]))
            roots = self.roots()
            hit = hit & (roots[x][:, None] != roots[y][None, :])
            if not hit.any():
                return


class Walk:
    """Dual traversal of two trees, or of one with itself; positions are those of a's runs, then of b's."""

    def __init__(self, a: CoverTree, b: CoverTree, wa: np.ndarray, wb: np.ndarray, least: float, same: bool) -> None:
        self.a, self.b, self.wa, self.wb, self.least, self.same = a, b, wa, wb, least, same
        self.tau = math.acos(least)
        self.shift = 0 if same else len(wa)
        self.tally = Tally(len(wa) if same else len(wa) + len(wb))
        self.united: set[tuple[int, int]] = set()
        self.open: list[tuple[int, int]] = []
        self.sum_a, self.sum_b = (np.concatenate([[0.0], np.cumsum(w)]) for w in (wa, wb))

    def run(self) -> Tally:
        if self.same and len(self.wa):
            inner = [0]
            while inner:
                inner += self.within(inner.pop())
        elif len(self.wa) and len(self.wb):
            self.level(np.zeros(1, np.int64), np.zeros(1, np.int64), False)
        while self.open:
            i, j = self.open.pop()
            self.pair(i, j)
        return self.tally

    def unite(self, lo: int, hi: int) -> None:
        if (lo, hi) not in self.united:
            self.united.add((lo, hi))
            for k in range(lo + 1, hi):
                self.tally.join(lo, k)

    def whole(self, i: int, j: int) -> None:
        """All members of both nodes link with each other."""
        x, y = (self.a.lo[i], self.a.hi[i]), (self.b.lo[j] + self.shift, self.b.hi[j] + self.shift)
        self.tally.add_run(*x, self.sum_b[self.b.hi[j]] - self.sum_b[self.b.lo[j]])
        self.tally.add_run(*y, self.sum_a[x[1]] - self.sum_a[x[0]])
        self.unite(int(x[0]), int(x[1]))
        self.unite(int(y[0]), int(y[1]))
        self.tally.join(int(x[0]), int(y[0]))

    def rows(self, x: np.ndarray, y: np.ndarray, half: bool) -> None:
        """Compare rows of a with rows of b, in tiles; ``half``: the same rows, each pair once."""
        for p in range(0, len(x), TALL):
            left = x[p : p + TALL]
            for q in range(p if half else 0, len(y), WIDE):
                right = y[q : q + WIDE]
                hit = self.a.points[left] @ self.b.points[right].T >= self.least
                if half:
                    hit &= (np.arange(q, q + len(right)) > np.arange(p, p + len(left))[:, None])
                self.tally.add_tile(left, right + self.shift, self.wa[left], self.wb[right], hit)

    def within(self, i: int) -> list[int]:
        """Pairs inside one node of a tree that meets itself; returns the children to do likewise."""
        lo, hi = int(self.a.lo[i]), int(self.a.hi[i])
        if 2 * self.a.radius[i] <= self.tau - MARGIN:
            self.tally.add_run(lo, hi, self.sum_a[hi] - self.sum_a[lo])
            self.tally.extra[lo:hi] -= self.wa[lo:hi]
            self.unite(lo, hi)
            return []
        if not self.a.n_kids[i]:
            rows = np.arange(lo, hi)
            self.rows(rows, rows, True)
            return []
        kids = np.arange(self.a.kids[i], self.a.kids[i] + self.a.n_kids[i])
        self.level(kids, kids, True)
        return kids[self.a.hi[kids] - self.a.lo[kids] > 1].tolist()

    def pair(self, i: int, j: int) -> None:
        a, b = self.a, self.b
        if not a.n_kids[i] and not b.n_kids[j]:
            self.rows(np.arange(a.lo[i], a.hi[i]), np.arange(b.lo[j], b.hi[j]), False)
            return
        left = np.arange(a.kids[i], a.kids[i] + a.n_kids[i]) if a.n_kids[i] else np.array([i])
        right = np.arange(b.kids[j], b.kids[j] + b.n_kids[j]) if b.n_kids[j] else np.array([j])
        self.level(left, right, False)

    def level(self, left: np.ndarray, right: np.ndarray, half: bool) -> None:
        """Compare two sets of nodes by their centres; single points, most nodes of scattered data, are rows at once."""
        a, b = self.a, self.b
        one, two = a.hi[left] - a.lo[left] == 1, b.hi[right] - b.lo[right] == 1
        self.rows(a.lo[left[one]], b.lo[right[two]], half)
        self.nodes(left[~one], right, False) if not half else self.nodes(left[~one], right[two], False)
        if half:
            self.nodes(left[~one], right[~two], True)
        else:
            self.nodes(left[one], right[~two], False)

    def nodes(self, left: np.ndarray, right: np.ndarray, half: bool) -> None:
        a, b = self.a, self.b
        for p in range(0, len(left), TALL):
            rows = left[p : p + TALL]
            for q in range(0, len(right), WIDE):
                columns = right[q : q + WIDE]
                cos = a.centres[rows] @ b.centres[columns].T
                reach = a.radius[rows][:, None] + b.radius[columns][None, :]
                keep = cos >= np.cos(np.minimum(reach + (self.tau + MARGIN), math.pi))
                if half:
                    keep &= columns[None, :] > rows[:, None]
                x, y = np.nonzero(keep)
                inside = np.arccos(np.clip(cos[x, y], -1.0, 1.0)) + reach[x, y] <= self.tau - MARGIN
                i, j = rows[x], columns[y]
                few = ~inside & (a.n_kids[i] + b.n_kids[j] == 0) & ((a.hi[i] - a.lo[i]) * (b.hi[j] - b.lo[j]) <= FEW)
                self.leaves(i[few], j[few])
                for m, n in zip(i[inside].tolist(), j[inside].tolist()):
                    self.whole(m, n)
                self.open += zip(i[~inside & ~few].tolist(), j[~inside & ~few].tolist())

    def leaves(self, i: np.ndarray, j: np.ndarray) -> None:
        """Rows of many pairs of small leaves."""
        a, b = self.a, self.b
        wide = b.hi[j] - b.lo[j]
        count = (a.hi[i] - a.lo[i]) * wide
        cuts = np.searchsorted(np.cumsum(count), np.arange(CHUNK, int(count.sum()) + CHUNK, CHUNK), side="right")
        for p, q in zip([0, *cuts.tolist()], [*cuts.tolist(), len(i)]):
            at = slice(p, q)
            of = np.repeat(np.arange(len(i))[at], count[at])
            step = np.arange(len(of)) - np.repeat(np.cumsum(count[at]) - count[at], count[at])
            x, y = a.lo[i[of]] + step // wide[of], b.lo[j[of]] + step % wide[of]
            hit = np.einsum("ij,ij->i", a.points[x], b.points[y]) >= self.least
            x, y = x[hit], y[hit]
            self.tally.add_pairs(x, y + self.shift, self.wa[x], self.wb[y])


def traverse(a: CoverTree, b: CoverTree, wa: np.ndarray, wb: np.ndarray, least: float, same: bool) -> Tally:
    """Links between a and b; ``w`` counts the equal vectors of a row, in the order of the runs."""
    return Walk(a, b, wa, wb, least, same).run()


class Cells:
    """Nested pivots of one length of vectors: cells of a cell are those nearest to its pivots."""

    def __init__(self, dim: int) -> None:
        self.dim, self.pivots, self.first, self.size = dim, {}, {}, 1
        self.own = {0: np.zeros(dim)}

    def split(self, cell: int, points: np.ndarray, parts: int) -> None:
        """Pivots are the means of a few rounds of nearest assignment, from points far apart."""
        picked, away = [0], angles(points, points[:1])[:, 0]
        while len(picked) < parts and away.max() > MARGIN:
            picked.append(int(away.argmax()))
            away = np.minimum(away, angles(points, points[picked[-1:]])[:, 0])
        pivots = points[picked]
        for _ in range(5):
            sums = np.zeros_like(pivots)
            np.add.at(sums, (points @ pivots.T).argmax(axis=1), points)
            norm = np.linalg.norm(sums, axis=1, keepdims=True)
            pivots = np.where(norm > MARGIN, sums / np.maximum(norm, MARGIN), pivots)
        if len(pivots) > 1:
            self.pivots[cell], self.first[cell] = pivots, self.size
            self.own |= {self.size + i: p for i, p in enumerate(pivots)}
            self.size += len(pivots)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each row, and its distance from the cell's pivot (pi where there is none)."""
        cell, away = np.zeros(len(x), np.int64), np.full(len(x), math.pi)
        for c in sorted(self.pivots):  # a cell comes before its own
            at = np.flatnonzero(cell == c)
            if len(at):
                cos = x[at] @ self.pivots[c].T
                cell[at] = self.first[c] + cos.argmax(axis=1)
                away[at] = np.arccos(np.clip(cos.max(axis=1), -1.0, 1.0))
        return cell, away


def _unit(column: pa.Array) -> list[bytes | None]:
    """Unit vectors in double precision, None where a vector links with nothing."""
    out: list[bytes | None] = [None] * len(column)
    sizes = np.diff(column.offsets.to_numpy())
    starts = column.offsets.to_numpy()[:-1]
    flat = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    there = column.is_valid().to_numpy(zero_copy_only=False)
    for dim in {*sizes[there].tolist()} - {0}:
        at = np.flatnonzero(there & (sizes == dim))
        x = flat[starts[at][:, None] + np.arange(dim)]
        top = np.abs(x).max(axis=1)
        good = np.isfinite(x).all(axis=1) & (top > 0)
        x = x[good] / top[good, None]  # no over- or underflow in the norm
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for i, row in zip(at[good].tolist(), x):
            out[i] = row.tobytes()
    return out


def near_duplicates(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = 4096, most_pivots: int = 2048, block: int = 65536) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    n_links counts the other rows at cosine ``least`` or more (equal vectors
    too); component_id is the smallest vec_id reachable, kept says whether it is
    the row's own. Vectors that are null, empty, zero or hold null or non-finite
    components have no links, and are their own component. Vectors of different
    lengths don't link. Repeated rows count as further vectors; a null id has a
    null ``kept`` unless other rows give it a component. An empty table gives no
    rows; further columns are ignored.
    """
    spark = vectors.sparkSession

    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = pa.array(_unit(batch.column(1)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), data, data.is_valid()], ["vec_id", "unit", "ok"])

    given = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("v"))
    raw = given.mapInArrow(usable, "vec_id bigint, unit binary, ok boolean")
    rows = written(raw.select("vec_id", "ok", "unit", F.xxhash64("unit").alias("h1"), F.xxhash64("unit", F.lit(1)).alias("h2")), "vectors")
    ids = rows.select("vec_id", "ok", "h1", "h2")
    classes = rows.where("ok").groupBy("h1", "h2").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"), F.first("unit").alias("unit"))
    classes = written(classes.select("h1", "h2", "low", "n", "unit", F.monotonically_increasing_id().alias("node")), "classes")

    sizes = {r["dim"]: r["n"] for r in classes.groupBy((F.octet_length("unit") / 8).cast("int").alias("dim")).agg(F.count("*").alias("n")).collect()}
    size = min(block, max(512, math.ceil(sum(sizes.values()) / 6)))
    # lengths of vectors are few; beyond ``most_pivots`` of them each is one cell
    known = {dim: Cells(dim) for dim in sorted(sizes, key=sizes.__getitem__, reverse=True)[:most_pivots]}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [np.frombuffer(u, np.float64) for u in batch.column("unit").to_pylist()]
            dims = np.array([len(u) for u in units], np.int32)
            cell, away = np.zeros(len(units), np.int32), np.full(len(units), math.pi)
            for dim in {*dims.tolist()}.intersection(known):
                at = np.flatnonzero(dims == dim)
                cell[at], away[at] = known[dim].place(np.array([units[i] for i in at]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dims), pa.array(cell), pa.array(away)], [*batch.schema.names, "dim", "cell", "away"])

    given = classes.select("node", "n", "unit", "h1")
    schema = "node bigint, n bigint, unit binary, h1 bigint, dim int, cell int, away double"
    large, tried = {(dim, 0): n for dim, n in sizes.items() if n > size and dim in known}, set()
    while large and (left := most_pivots - sum(len(c.own) for c in known.values())) > 1:
        large = dict(sorted(large.items(), key=lambda x: -x[1])[: left // 2])
        each, most = max(64, sample // len(large)), min(64, left // len(large))
        share = spark.createDataFrame([(d, c, min(1.0, 2 * each / n)) for (d, c), n in large.items()], "dim int, cell int, share double")
        drawn = given.mapInArrow(placed, schema).join(F.broadcast(share), ["dim", "cell"]).where(F.pmod(F.xxhash64("h1"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
        points: dict[tuple[int, int], list[np.ndarray]] = {}
        for r in drawn.select("dim", "cell", "unit", "h1").orderBy("h1").limit(4 * sample).collect():
            points.setdefault((r["dim"], r["cell"]), []).append(np.frombuffer(r["unit"], np.float64))
        for (dim, cell), some in points.items():
            known[dim].split(cell, np.array(some), min(most, math.ceil(large[dim, cell] / size)))
        tried |= large.keys()
        counts = {(r["dim"], r["cell"]): r["count"] for r in given.mapInArrow(placed, schema).groupBy("dim", "cell").count().collect()}
        large = {k: n for k, n in counts.items() if n > 1.5 * size and k[0] in known and k not in tried}

    in_cells = written(given.mapInArrow(placed, schema), "cells")
    # at most ``most_pivots`` rows and one for each further length of vectors
    cells = {(r["dim"], r["cell"]): (r["count"], r["radius"]) for r in in_cells.groupBy("dim", "cell").agg(F.count("*").alias("count"), F.max("away").alias("radius")).collect()}
    # blocks are numbered by cell; a cell that is still too large is dealt to several by hash
    first, blocks, at = {}, [], 0
    for key, (count, _) in sorted(cells.items()):
        parts = math.ceil(count / (1.5 * size))
        first[key] = (at, parts)
        blocks += [key] * parts
        at += parts
    tau = math.acos(least)
    partners: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for dim in sizes:
        keys = [k for k in cells if k[0] == dim]
        radii = np.array([cells[k][1] for k in keys])
        near = np.ones((len(keys), len(keys)), bool)
        if len(keys) > 1:
            pivots = np.array([known[dim].own[k[1]] for k in keys])
            near = angles(pivots, pivots) <= radii[:, None] + radii[None, :] + tau + MARGIN
            np.fill_diagonal(near, True)
        partners |= {k: [keys[j] for j in np.flatnonzero(near[i])] for i, k in enumerate(keys)}

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        points = np.array([np.frombuffer(u, np.float64) for u in pdf["unit"]])
        tree = CoverTree(points, tau / 16)
        me = int(pdf["block"].iloc[0])
        to = sorted({b for key in partners[blocks[me]] for b in range(first[key][0], sum(first[key]))})
        data = pickle.dumps((tree, pdf["node"].to_numpy()[tree.order], pdf["n"].to_numpy()[tree.order].astype(float)), protocol=5)
        return pd.DataFrame({"block": [me], "partners": [to], "tree": [data]})

    table = spark.createDataFrame([(d, c, s, p) for (d, c), (s, p) in first.items()], "dim int, cell int, start int, parts int")
    blocked = in_cells.join(F.broadcast(table), ["dim", "cell"]).select((F.col("start") + F.pmod("h1", F.col("parts"))).cast("int").alias("block"), "node", "n", "unit")
    grown = written(blocked.groupBy("block").applyInPandas(grow, "block int, partners array<int>, tree binary"), "trees")
    pairs = grown.select("block", "tree", F.explode("partners").alias("other")).select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "tree")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        loaded = [pickle.loads(t) for t in pdf.sort_values("block")["tree"]]
        (a, na, wa), (b, nb, wb) = loaded[0], loaded[-1]
        same = len(loaded) == 1
        tally = traverse(a, b, wa, wb, least, same)
        nodes = na if same else np.concatenate([na, nb])
        hit = np.flatnonzero(tally.links > 0)
        return pd.DataFrame({"node": nodes[hit], "links": tally.links[hit].astype(np.int64), "root": nodes[[tally.root(int(i)) for i in hit]] if len(hit) else np.array([], np.int64)})

    found = written(pairs.groupBy("i", "j").applyInPandas(meet, "node bigint, links bigint, root bigint"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found, "node", "root")
    members = classes.drop("unit").join(links, "node", "left").join(roots, "node", "left").select("h1", "h2", "low", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    members = written(members, "members")
    least_id = members.groupBy("root").agg(F.min("low").alias("component_id"))
    of = written(members.join(least_id, "root").select("h1", "h2", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id", F.lit(True).alias("ok")), "result")
    out = ids.join(of, ["h1", "h2", "ok"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
