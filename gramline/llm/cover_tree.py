"""Near-duplicate vectors by cosine: cover trees and dual traversal.

Vectors are compared inside their label as points of the unit sphere, where a cosine of at least t is a distance of at
most sqrt(2 - 2t). A cover tree's nodes hold a centre and all points within a radius; each level's nodes lie inside
those of the level above, with half the radius. Two trees are traversed together: a pair of nodes farther apart than
their radii and the threshold is left, a pair wholly within it links all its points at once, others are opened, and
points that remain are compared by their cosine. No pair is missed, and none below the threshold is linked.

Exact copies are one point with a weight. A label of up to CELL points is one tree. A larger one is cut into cells
around sampled points, of at most about CELL points each; a point also visits every later cell that its distance to the
cell's centre and the cell's radius leave within reach. Cells that no bound tells apart are compared block by block.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramline.llm.graph import components
from gramline.plans.lookup import BROADCAST_BYTES, lookup_join
from gramline.plans.storage import written

CELL = 8192
LEAF = 24
ROWS = 512  # centres compared at once with all others
SLACK = 1e-6  # more than the rounding of a distance made from a product
MOST_EDGES = 1 << 20
KEY = ["label", "dim"]
PLACE = [*KEY, "cell", "block", "chunk"]


class CoverTree:
    """Nodes over the rows of `points`, unit vectors. Node k has the rows `order[lo[k]:hi[k]]`, row `center[k]` in the
    middle and nothing beyond `radius[k]`; `kids[k]` lists the nodes inside it, none for a leaf."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self._leaf = points, leaf
        self.center, self.radius, self.lo, self.hi, self.kids = [], [], [], [], []
        self._order: list[np.ndarray] = []
        self._placed = 0
        rows = np.arange(len(points))
        self._add(rows, 0, _distances(points, points[:1])[:, 0])
        self.order = np.concatenate(self._order)
        self.radius = np.array(self.radius)
        self.centers = points[self.center]

    def _add(self, rows: np.ndarray, center: int, far: np.ndarray) -> int:
        node = len(self.center)
        radius = float(far.max())
        self.center.append(center)
        self.radius.append(radius)
        self.lo.append(self._placed)
        self.hi.append(0)
        self.kids.append([])
        if len(rows) <= self._leaf or radius <= SLACK:
            self._order.append(rows)
            self._placed += len(rows)
        else:
            half = 2.0
            while half >= radius:
                half /= 2
            self.kids[node] = [self._add(*part) for part in self._cover(rows, center, far, half)]
        self.hi[node] = self._placed
        return node

    def _cover(self, rows: np.ndarray, center: int, far: np.ndarray, radius: float):
        """Parts (rows, centre, distances) within `radius` of their centres; the node's own centre stays one."""
        near = far <= radius
        parts = [(rows[near], center, far[near])]
        rest = rows[~near]
        while len(rest):
            block = rest[:ROWS]
            apart = _distances(self.points[rest], self.points[block])
            open_ = np.ones(len(rest), bool)
            for j in range(len(block)):
                if open_[j]:
                    own = open_ & (apart[:, j] <= radius)
                    own[j] = True
                    parts.append((rest[own], int(block[j]), apart[own, j]))
                    open_ &= ~own
            rest = rest[open_]
        return parts

    def rows(self, node: int) -> np.ndarray:
        return self.order[self.lo[node] : self.hi[node]]

    def opened(self, node: int) -> np.ndarray:
        return np.array(self.kids[node] or [node])


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ y.T), 0.0))


def roots_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number that each of n nodes reaches by the edges i - j."""
    root = np.arange(n)
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


class Links:
    """What a traversal finds over n points: for each the weight of the points linked with it, and a forest of links."""

    def __init__(self, weight: np.ndarray):
        self.weight, self.linked = weight, np.zeros(len(weight), np.int64)
        self._edges, self._n = [], 0

    def _join(self, i: np.ndarray, j: np.ndarray) -> None:
        self._edges.append((i, j))
        self._n += len(i)
        if self._n > MOST_EDGES:
            root = self.roots()
            tied = np.flatnonzero(root != np.arange(len(root)))
            self._edges, self._n = [(tied, root[tied])], len(tied)

    def pairs(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.linked, i, self.weight[j])
        np.add.at(self.linked, j, self.weight[i])
        self._join(i, j)

    def all_of(self, x: np.ndarray) -> None:
        """All pairs inside x."""
        self.linked[x] += self.weight[x].sum() - self.weight[x]
        self._join(np.full(len(x), x[0]), x)

    def add(self, x: np.ndarray, weight: int) -> None:
        """Links every point of x, at least one, with points of this weight that are all linked with all of x."""
        self.linked[x] += weight
        self._join(np.full(len(x), x[0]), x)

    def tie(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs of linked points whose weights are added elsewhere."""
        self._join(i, j)

    def roots(self) -> np.ndarray:
        if not self._edges:
            return np.arange(len(self.weight))
        return roots_of(len(self.weight), *map(np.concatenate, zip(*self._edges, strict=True)))


class _Side:
    """A tree's part in a traversal: its points' numbers in the links, and the weight that is still to be linked with all
    points of each node."""

    def __init__(self, tree: CoverTree, raw: np.ndarray, weight: np.ndarray, shift: int):
        self.tree, self.raw, self.shift = tree, raw, shift
        self.norm = np.linalg.norm(raw, axis=1)
        self.lo, self.hi, self.center = np.array(tree.lo), np.array(tree.hi), np.array(tree.center)
        before = np.r_[0, np.cumsum(weight[tree.order + shift])]
        self.weight = before[self.hi] - before[self.lo]
        self.added = np.zeros(len(self.lo), np.int64)

    def flush(self, links: Links) -> None:
        for node in np.flatnonzero(self.added):
            links.add(self.tree.rows(node) + self.shift, self.added[node])


def _compare_points(a: _Side, b: _Side, i: np.ndarray, j: np.ndarray, least: float, links: Links) -> None:
    for first in range(0, len(i), ROWS * ROWS):
        x, y = i[first : first + ROWS * ROWS], j[first : first + ROWS * ROWS]
        near = np.einsum("ij,ij->i", a.raw[x], b.raw[y]) / (a.norm[x] * b.norm[y]) >= least
        links.pairs(x[near] + a.shift, y[near] + b.shift)


def traverse(a: CoverTree, b: CoverTree, raw_a: np.ndarray, raw_b: np.ndarray, least: float, links: Links, shift: int = 0) -> None:
    """Finds all pairs of a point of `a` and a point of `b` with a cosine of at least `least`; with `a is b` all pairs
    of different points. Points of `b` are numbered from `shift` in `links`."""
    reach = np.sqrt(max(2.0 - 2.0 * least, 0.0))
    own = _Side(a, raw_a, links.weight, 0)
    other = own if a is b else _Side(b, raw_b, links.weight, shift)
    stack = [(0, 0)]
    while stack:
        p, q = stack.pop()
        same = a is b and p == q
        if same and 2 * a.radius[p] <= reach - SLACK:
            links.all_of(a.rows(p))
            continue
        if not a.kids[p] and not b.kids[q]:
            i, j = np.repeat(a.rows(p), b.hi[q] - b.lo[q]), np.tile(b.rows(q), a.hi[p] - a.lo[p])
            once = i < j if same else slice(None)
            _compare_points(own, other, i[once], j[once], least, links)
            continue
        left, right = a.opened(p), b.opened(q)
        for first in range(0, len(left), ROWS):
            x = left[first : first + ROWS]
            y = right[first:] if same else right
            apart = _distances(a.centers[x], b.centers[y])
            sizes = a.radius[x][:, None] + b.radius[y][None, :]
            keep = apart - sizes <= reach + SLACK
            if same:
                keep &= np.arange(len(x))[:, None] <= np.arange(len(y))[None, :]
            whole = keep & (apart + sizes <= reach - SLACK)
            if same:
                whole &= x[:, None] != y[None, :]
            if whole.any():
                np.add.at(own.added, x, whole @ other.weight[y])
                np.add.at(other.added, y, own.weight[x] @ whole)
                i, j = np.nonzero(whole)
                links.tie(own.center[x[i]], other.center[y[j]] + shift)
            i, j = np.nonzero(keep & ~whole)
            i, j = x[i], y[j]
            single = (own.hi[i] - own.lo[i] == 1) & (other.hi[j] - other.lo[j] == 1)
            if same:
                single &= i != j
            _compare_points(own, other, own.center[i[single]], other.center[j[single]], least, links)
            stack += zip(i[~single].tolist(), j[~single].tolist(), strict=True)
    own.flush(links)
    if other is not own:
        other.flush(links)


def _unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1)[:, None]


def _compare(least: float):
    """Of one place's points: its own pairs (chunk -1), or those of visitors with residents."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["visits", "ref"], kind="stable")
        raw = np.array(frame["vector"].tolist(), np.float64)
        unit, n = _unit(raw), int((~frame["visits"]).sum())
        links = Links(frame["n"].to_numpy(np.int64))
        if frame["chunk"].iat[0] < 0:
            tree = CoverTree(unit)
            traverse(tree, tree, raw, raw, least, links)
        elif 0 < n < len(frame):
            traverse(CoverTree(unit[:n]), CoverTree(unit[n:]), raw[:n], raw[n:], least, links, shift=n)
        ref = frame["ref"].to_numpy(np.int64)
        return pd.DataFrame({"ref": ref, "linked": links.linked, "root": ref[links.roots()]})[links.linked > 0]

    return run


def _matrices(rows: list, *others: str) -> dict:
    """{(label, dim): (unit vectors, other columns...)} of collected rows."""
    grouped: dict = {}
    for row in rows:
        grouped.setdefault((row["label"], row["dim"]), []).append(row)
    return {
        key: (_unit(np.array([r["vector"] for r in own], np.float64)), *(np.array([r[c] for r in own]) for c in others))
        for key, own in grouped.items()
    }


def _by_key(batch: pa.RecordBatch):
    """(key, row numbers, unit vectors) of a batch's rows, key by key."""
    frame = batch.select([*KEY]).to_pandas()
    vectors = batch.column(batch.schema.get_field_index("vector"))
    for key, own in frame.groupby(KEY).indices.items():
        yield key, own, _unit(np.array(vectors.take(pa.array(own)).to_pylist(), np.float64))


def _pivots(points: DataFrame, cell: int, limit: int) -> DataFrame:
    """A hashed sample of about two points a cell, fewer where that is more than `limit` bytes."""
    step = max(1, cell // 2)
    while True:
        drawn = written(points.filter(F.pmod(F.xxhash64("ref"), F.lit(step)) == 0), "pivots")
        if (drawn.agg(F.sum(F.col("dim") * 8)).first()[0] or 0) <= limit:
            return drawn
        step *= 2


def _in_cells(points: DataFrame, cell: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Points of large labels with their cell and block, and the cells (label, dim, cell, vector, radius, blocks)."""
    spark = points.sparkSession
    pivots = _pivots(points, cell, limit)
    middles = spark.sparkContext.broadcast(_matrices(pivots.orderBy("ref").collect(), "ref"))
    schema = points.schema.simpleString()[len("struct<") : -1]

    def assign(batches):
        for batch in batches:
            cells, apart = np.zeros(batch.num_rows, np.int64), np.full(batch.num_rows, 2.0)
            for key, own, unit in _by_key(batch):
                if key in middles.value:
                    centers, ref = middles.value[key]
                    far = _distances(unit, centers)
                    best = far.argmin(axis=1)
                    cells[own], apart[own] = ref[best], far[np.arange(len(own)), best]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells), pa.array(apart)], [*batch.schema.names, "cell", "apart"])

    placed = written(points.mapInArrow(assign, f"{schema}, cell bigint, apart double"), "placed")
    sizes = placed.groupBy(*KEY, "cell").agg(F.count("*").alias("size"), F.max("apart").alias("radius"))
    blocks = sizes.withColumn("blocks", F.ceil(F.col("size") / cell).cast("int"))
    centers = pivots.select(*KEY, F.col("ref").alias("cell"), "vector")
    # A label without a sampled point is one cell of radius 2, all of the sphere, and needs no centre.
    cells = written(blocks.join(centers, [*KEY, "cell"], "left"), "cells")
    block = F.pmod(F.xxhash64("ref"), F.col("blocks")).cast("int")
    joined = lookup_join(placed, cells.select(*KEY, "cell", "blocks", F.col("size").alias("weight")), [*KEY, "cell"], weight="weight")
    return written(joined.withColumn("block", block).drop("blocks", "apart"), "in-blocks"), cells


def _visits(placed: DataFrame, cells: DataFrame, least: float) -> DataFrame:
    """A row for each later block, of any cell within reach, that a point visits: its cell and block are that block's."""
    reach = np.sqrt(max(2.0 - 2.0 * least, 0.0)) + SLACK
    around: dict = {}
    for row in cells.orderBy(*KEY, "cell").collect():
        around.setdefault((row["label"], row["dim"]), []).append(row)
    packed = {}
    for key, own in around.items():
        center = np.array([r["vector"] or [0.0] * key[1] for r in own], np.float64)
        norm = np.linalg.norm(center, axis=1)[:, None]
        cell, radius, blocks = (np.array([r[c] for r in own]) for c in ("cell", "radius", "blocks"))
        packed[key] = center / np.where(norm > 0, norm, 1.0), cell, radius, blocks
    shared = placed.sparkSession.sparkContext.broadcast(packed)

    def spread(batches):
        for batch in batches:
            home_cell, home_block = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("cell", "block"))
            rows, cells_, blocks_ = [], [], []
            for key, own, unit in _by_key(batch):
                center, cell, radius, blocks = shared.value[key]
                near = _distances(unit, center) <= radius[None, :] + reach
                near &= cell[None, :] >= home_cell[own][:, None]
                x, c = np.nonzero(near)
                again = np.repeat(np.arange(len(x)), blocks[c])
                block = np.arange(len(again)) - np.repeat(np.cumsum(blocks[c]) - blocks[c], blocks[c])
                x, c = own[x[again]], cell[c[again]]
                later = (c > home_cell[x]) | (block > home_block[x])
                rows.append(x[later])
                cells_.append(c[later])
                blocks_.append(block[later])
            if rows:
                taken = batch.take(pa.array(np.concatenate(rows)))
                new = {"cell": pa.array(np.concatenate(cells_)), "block": pa.array(np.concatenate(blocks_).astype(np.int32))}
                yield pa.RecordBatch.from_arrays([new.get(n, col) for n, col in zip(taken.schema.names, taken.columns, strict=True)], taken.schema.names)

    return placed.mapInArrow(spread, placed.schema)


def links(points: DataFrame, least: float, cell: int = CELL, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(ref, linked, root): the weight of the points linked with each point, and a member of its component, for points
    (label, dim, ref, n, vector) that have any link. Refs are unique, vectors finite and not zero."""
    sizes = written(points.groupBy(*KEY).agg(F.count("*").alias("size")), "sizes")
    large = sizes.filter(F.col("size") > cell)
    at = lambda df, chunk, visits: df.withColumns({"chunk": chunk, "visits": F.lit(visits)})
    whole = {"cell": F.lit(0).cast("bigint"), "block": F.lit(0)}
    out = "ref bigint, linked bigint, root bigint"
    if large.isEmpty():
        only = at(points.withColumns(whole), F.lit(-1), False)
        return written(only.groupBy(*PLACE).applyInPandas(_compare(least), out), "links")
    known = lookup_join(points, sizes.withColumn("weight", F.col("size")), KEY, weight="weight")
    small = known.filter(F.col("size") <= cell).drop("size").withColumns(whole)
    placed, cells = _in_cells(known.filter(F.col("size") > cell).drop("size"), cell, limit)
    visits = written(_visits(placed, cells, least), "visits")
    loads = visits.groupBy(*KEY, "cell", "block").agg(F.count("*").alias("load"))
    loads = written(loads.withColumn("chunks", F.ceil(F.col("load") / cell).cast("int")), "loads")
    block = [*KEY, "cell", "block"]
    visitors = lookup_join(visits, loads.drop("load").withColumn("weight", F.col("chunks")), block, weight="weight")
    hosts = lookup_join(placed, loads.drop("load").withColumn("weight", F.col("chunks")), block, weight="weight")
    own = at(small.unionByName(placed), F.lit(-1), False)
    hosts = at(hosts, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)), False).drop("chunks")
    visitors = at(visitors, F.pmod(F.xxhash64("ref", F.lit(1)), F.col("chunks")).cast("int"), True).drop("chunks")
    groups = own.unionByName(hosts).unionByName(visitors)
    found = written(groups.groupBy(*PLACE).applyInPandas(_compare(least), out), "found")
    totals = found.groupBy("ref").agg(F.sum("linked").alias("linked"))
    roots = components(found.select("ref", "root"), "ref", "root")
    joined = totals.join(roots, F.col("ref") == F.col("node"), "left")
    return written(joined.select("ref", "linked", F.coalesce("root", "ref").alias("root")), "links")


def _square(vector: str) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def near_duplicates(
    vectors: DataFrame, least: float = 0.98, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    cell: int = CELL,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row: how many other rows are linked with it, the smallest id reachable
    by links, its own included, and whether that is its own.

    Rows with the same label and number of components are linked if their cosine is at least `least`. A row links with
    nothing if its label or vector is null, its vector is empty or zero, or a component is null or not finite. Rows that
    repeat an id are vectors of their own; a null id is larger than all others. Other columns are not carried.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("own"), F.col(id).alias("vec"), F.col(label).alias("label"),
        F.col(vector).alias("vector"),
    )
    square = _square("vector")
    linkable = F.col("label").isNotNull() & (F.size("vector") > 0) & (square > 0) & (square < F.lit(float("inf")))
    rows = written(rows.withColumn("linkable", F.coalesce(linkable, F.lit(False))), "vectors")
    candidates = rows.filter("linkable").drop("linkable")
    groups = candidates.groupBy("label", "vector").agg(
        F.min("own").alias("ref"), F.count("*").alias("n"), F.min("vec").alias("least_id")
    )
    groups = written(groups.withColumn("dim", F.size("vector")), "points")
    found = links(groups.select(*KEY, "ref", "n", "vector"), least, cell)
    points = groups.select("ref", "n", "least_id").join(found, "ref", "left").withColumn("root", F.coalesce("root", "ref"))
    points = written(points, "linked-points")
    smallest = written(points.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("weight")), "roots")
    points = lookup_join(points, smallest, ["root"], weight="weight")
    points = points.select("ref", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id", F.col("n").alias("weight"))
    copies = groups.filter("n > 1").select("label", "vector", "ref", "n")
    member = lookup_join(candidates, copies, ["label", "vector"], "left", weight="n").withColumn("ref", F.coalesce("ref", "own"))
    linked = lookup_join(member.select("vec", "ref"), written(points, "point-results"), ["ref"], weight="weight")
    single = rows.filter("NOT linkable").select("vec", F.lit(0).cast("bigint").alias("n_links"), F.col("vec").alias("component_id"))
    every = reduce(DataFrame.unionByName, [linked.select("vec", "n_links", "component_id"), single])
    return every.select(
        F.col("vec").alias(id), "n_links", "component_id", F.col("vec").eqNullSafe(F.col("component_id")).alias("kept")
    )
