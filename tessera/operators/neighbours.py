"""Exact k nearest neighbours by a block index.

Donors are cut into small leaves by a tree of median splits, one tree for each
value of the partition columns, grown on a hashed sample of bounded size; every
donor goes to its leaf, and each leaf has the box around its points. Leaves side
by side make a cell, which is stored as blocks, one row a block. A split on a
coordinate sends donors that lack it to a third child, so that leaves tell
patterns of missing values apart. Vectors with more
than ``AXES`` coordinates are indexed by their leading principal axes: an
orthonormal projection never lengthens a difference, so the distance to a box
stays a lower bound.

A query first visits the leaves next to it, which gives an upper bound of its
k-th distance, and then every leaf whose box is within that bound. Queries meet
a block in batches, each for the leaves that it asks for, and only the k best of
a block leave it: pairs are never rows. The sample and the trees decide the work, not the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tessera.session import written

#: Coordinates that boxes have at most, numbers and rows that the sample holds at most: rows, leaves and boxes pass through the driver.
AXES, SAMPLE, ROWS = 16, 1 << 21, 1 << 16
#: Donors in a leaf and in a block, donors that a query visits first, and queries that meet a block at a time.
LEAF, BLOCK, FIRST, BATCH = 16, 512, 1024, 512
#: Numbers in one matrix of bounds or distances.
CELLS = 1 << 22


@dataclass
class Tree:
    """Median splits: feature (-1: leaf), threshold, and where values below, at or above it and missing ones go."""

    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray   # nodes × 3; a leaf's first entry is its number
    cell: np.ndarray    # of each leaf; leaves of a subtree follow each other

    @staticmethod
    def grow(z: np.ndarray, leaf: int, cell: int) -> "Tree":
        """Leaves of ``leaf`` rows at most where rows differ, cells of about ``cell`` rows."""
        feature, threshold, child, size = [-1], [0.0], [[0, 0, 0]], []
        todo = [(0, np.arange(len(z)))]
        while todo:
            node, rows = todo.pop()
            cut = _cut(z[rows]) if len(rows) > leaf else None
            if cut is None:
                child[node] = [len(size), 0, 0]
                size.append(len(rows))
                continue
            j, t = cut
            v = z[rows, j]
            feature[node], threshold[node] = j, t
            child[node] = [len(feature) + i for i in range(3)]
            for part in (rows[v < t], rows[v >= t], rows[np.isnan(v)]):
                todo.append((len(feature), part))
                feature.append(-1)
                threshold.append(0.0)
                child.append([0, 0, 0])
        return Tree(np.array(feature), np.array(threshold), np.array(child), (np.cumsum(size) - size) // cell)

    def leaf_of(self, z: np.ndarray) -> np.ndarray:
        at = np.zeros(len(z), np.int64)
        while len(inner := np.nonzero(self.feature[at] >= 0)[0]):
            node = at[inner]
            v = z[inner, self.feature[node]]
            at[inner] = self.child[node, np.where(np.isnan(v), 2, (v >= self.threshold[node]).astype(int))]
        return self.child[at, 0]


def _cut(z: np.ndarray):
    """Coordinate of the widest spread, weighed by how many rows have it, and its median; None if all rows agree."""
    n = (~np.isnan(z)).sum(0)
    at = np.where(np.isnan(z), 0.0, z)
    mean = at.sum(0) / np.maximum(n, 1)
    spread = np.where(np.isnan(z), 0.0, (z - mean) ** 2).sum(0)
    for j in np.argsort(-spread, kind="stable"):
        v = np.sort(z[~np.isnan(z[:, j]), j])
        if len(v) and v[0] < v[-1]:
            t = v[len(v) // 2]
            return int(j), float(t if t > v[0] else v[np.searchsorted(v, t, side="right")])
    return None


@dataclass
class Boxes:
    """Leaves of one tree: box, which coordinates any and all of its donors have, and how many donors there are."""

    leaf: np.ndarray
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    any: np.ndarray
    all: np.ndarray
    n: np.ndarray

    def bounds(self, z: np.ndarray, scale: float, p: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Lower bounds of the distance to each leaf's donors, and the distances to the boxes' centres (queries × leaves)."""
        near = np.zeros((len(z), len(self.leaf)))
        mid = np.zeros_like(near)
        for j in range(z.shape[1]):
            q = z[:, j, None]
            gap = np.maximum(np.maximum(self.low[:, j] - q, q - self.high[:, j]), 0.0)
            near += np.where(self.all[:, j] & ~np.isnan(q), gap, 0.0) ** 2
            some = self.any[:, j]  # elsewhere the box is empty
            mid[:, some] += np.nan_to_num(q - (self.low[some, j] / 2 + self.high[some, j] / 2)) ** 2
        if p is None:
            rough = 1e-10 * (np.abs(z).max(1, initial=0.0)[:, None] + np.maximum(np.abs(self.low), np.abs(self.high)).max(1, initial=0.0))
            return np.sqrt(near) * scale * (1 - 1e-9) - rough * scale, np.sqrt(mid)
        common = (~np.isnan(z)).astype(float) @ self.any.T.astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            factor = np.where(common > 0, p / common, np.inf)
            return np.where(common > 0, np.sqrt(factor * near) * (1 - 1e-9), np.inf), np.where(common > 0, np.sqrt(factor * mid), np.inf)


    def pair_bounds(self, z: np.ndarray, leaf: np.ndarray, scale: float, p: int | None) -> np.ndarray:
        """The lower bounds of ``bounds`` for single pairs: the i-th query and the leaf at place ``leaf[i]``."""
        near, common, rough = np.zeros(len(z)), np.zeros(len(z)), np.zeros(len(z))
        for j in range(z.shape[1]):
            q, low, high = z[:, j], self.low[leaf, j], self.high[leaf, j]
            there = ~np.isnan(q)
            near += np.where(self.all[leaf, j] & there, np.maximum(np.maximum(low - q, q - high), 0.0), 0.0) ** 2
            common += there & self.any[leaf, j]
            if p is None:
                rough = np.maximum(rough, np.abs(q) + np.maximum(np.abs(low), np.abs(high)))
        if p is None:
            return np.sqrt(near) * scale * (1 - 1e-9) - 1e-10 * rough * scale
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(common > 0, np.sqrt(p / common * near) * (1 - 1e-9), np.inf)

    def cells(self) -> "Boxes":
        """The boxes around all leaves of each cell; ``leaf`` is the place of a cell's first leaf."""
        at = np.nonzero(np.append(True, self.cell[1:] != self.cell[:-1]))[0]
        of = lambda f, x: f.reduceat(x, at, axis=0)
        return Boxes(at, self.cell[at], of(np.minimum, self.low), of(np.maximum, self.high), of(np.logical_or, self.any), of(np.logical_and, self.all),
                     of(np.add, self.n))


def distances(q: np.ndarray, d: np.ndarray, scale: float, p: int | None) -> np.ndarray:
    """Euclidean distances times ``scale``, or nan-Euclidean ones of vectors with ``p`` features (nothing in common: infinite)."""
    acc = np.zeros((len(q), len(d)))
    for j in range(q.shape[1]):
        diff = q[:, j, None] - d[None, :, j]
        diff *= diff
        if p is not None:  # as nan_to_num, which for the small matrices of a leaf costs more than the rest
            np.minimum(diff, np.finfo(np.float64).max, out=diff)
            np.copyto(diff, 0.0, where=np.isnan(diff))
        acc += diff
    if p is None:
        return np.sqrt(acc * (scale * scale))
    common = (~np.isnan(q)).astype(float) @ (~np.isnan(d)).T.astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(common > 0, np.sqrt(p / common * acc), np.inf)


def nearest_in(dist: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k least finite entries of each row, ties to the first column."""
    at = min(k, dist.shape[1])
    edge = np.partition(dist, at - 1, axis=1)[:, at - 1, None]
    row, col = np.nonzero((dist <= edge) & np.isfinite(dist))
    order = np.lexsort((col, dist[row, col], row))
    row, col = row[order], col[order]
    start = np.searchsorted(row, np.arange(len(dist)))
    keep = np.arange(len(row)) - start[row] < k
    return row[keep], col[keep]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of a matrix; nulls are NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


@dataclass
class Plan:
    """What tasks need: trees by part, axes, boxes by part."""

    trees: dict
    centre: np.ndarray
    axes: np.ndarray | None
    boxes: dict = field(default_factory=dict)

    def place(self, x: np.ndarray) -> np.ndarray:
        return x if self.axes is None else (x - self.centre) @ self.axes.T


class BlockIndex:
    """An index over donors ``_p`` (struct), ``_d`` (key), ``_dv`` (array<double>).

    ``p``: number of features of the nan-Euclidean distance, whose vectors may lack coordinates; None for complete
    vectors, whose distance is multiplied by ``scale``. ``copies``: how many donors with one vector can be wanted.
    """

    def __init__(self, donors: DataFrame, width: int, copies: int, p: int | None = None, scale: float = 1.0, leaf: int = LEAF,
                 block: int = BLOCK, first: int = FIRST):
        self.width, self.p, self.scale, self.leaf, self.block, self.first = width, p, scale, leaf, block, first
        spark = donors.sparkSession
        # of donors with one vector only the smallest keys can be chosen: limited in each task before the exchange
        same = W.partitionBy("_p", "_dv").orderBy("_d")
        d0 = written(donors.withColumn("_r", F.row_number().over(same)).where(F.col("_r") <= copies).drop("_r"), "donors").select("_p", "_d", "_dv")
        self.n = d0.count()
        self.plan = self._grow(d0)
        shared = spark.sparkContext.broadcast(self.plan)

        def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                z = shared.value.place(matrix(b.column("_dv"), width))
                at = np.zeros((len(z), 2), np.int32)
                for part, rows in _parts(b.column("_p")):
                    if tree := shared.value.trees.get(part):
                        number = tree.leaf_of(z[rows])
                        at[rows] = np.column_stack([tree.cell[number], number])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at[:, 0]), pa.array(at[:, 1])], names=[*b.schema.names, "_cell", "_leaf"])

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from Packer(width, block, shared.value).run(batches)

        ints, doubles, flags = T.ArrayType(T.IntegerType()), T.ArrayType(T.DoubleType()), T.ArrayType(T.BooleanType())
        of = lambda **kinds: [T.StructField(c, t) for c, t in kinds.items()]
        cell, leaf_no = of(_cell=T.IntegerType(), _leaf=T.IntegerType())
        placed = d0.mapInArrow(leaves, T.StructType([*d0.schema, cell, leaf_no]))
        schema = T.StructType([d0.schema["_p"], cell, *of(_n=T.LongType(), _keys=T.ArrayType(d0.schema["_d"].dataType), _vec=T.BinaryType(), _leaves=ints),
                               leaf_no, *of(_low=doubles, _high=doubles, _any=flags, _all=flags)])
        # a given number of partitions: small data, much work
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        packed = placed.repartition(self.parts, "_p", "_cell").sortWithinPartitions("_p", "_cell", "_leaf", "_d").mapInArrow(blocks, schema)
        stored = written(packed, "blocks")
        self.blocks = stored.where("_vec IS NOT NULL").select("_p", "_cell", "_n", "_keys", "_vec", "_leaves")
        # boxes of the trees' leaves, which are no more than the sample's rows
        meta: dict = {}
        for r in stored.where("_low IS NOT NULL").select("_p", "_leaf", "_cell", "_low", "_high", "_any", "_all", "_n").collect():
            meta.setdefault(tuple(r["_p"]), []).append(tuple(r)[1:])
        for part, rows in meta.items():
            self.plan.boxes[part] = Boxes(*(np.array(c) for c in zip(*sorted(rows, key=lambda r: r[0]))))
        self.shared = spark.sparkContext.broadcast(self.plan)

    def _grow(self, d0: DataFrame) -> Plan:
        """Trees from a sample of at most about ``SAMPLE`` numbers in ``ROWS`` rows, drawn by a hash of the key."""
        size = max(1024, min(ROWS, SAMPLE // max(1, self.width)))
        rows = d0 if self.n <= size else d0.where(F.pmod(F.xxhash64(F.lit("block index"), "_d"), F.lit(1 << 40)) < int(size / self.n * (1 << 40)))
        parts: dict = {}
        for r in rows.select("_p", "_dv").collect():
            parts.setdefault(tuple(r["_p"]), []).append(r["_dv"])
        every = np.array([v for vs in parts.values() for v in vs], np.float64).reshape(-1, self.width)
        centre, axes = np.zeros(self.width), None
        if self.p is None and self.width > AXES and len(every):
            centre = every.mean(0)
            axes = np.linalg.svd(every - centre, full_matrices=False)[2][:AXES]
        plan = Plan({}, centre, axes)
        share = min(1.0, size / max(1, self.n))
        leaf, cell = max(2, round(self.leaf * share)), max(2, round(self.block * share))
        for part, vectors in parts.items():
            if len(vectors) > leaf:
                plan.trees[part] = Tree.grow(plan.place(np.array(vectors, np.float64)), leaf, cell)
        return plan

    def nearest(self, queries: DataFrame, k: int, exclude_self: bool = False, stats: dict | None = None) -> DataFrame:
        """_p, _q, _d, nn_rank, dist for the k nearest donors of each query ``_p``, ``_q``, ``_qv`` (fewer where there are
        fewer), ties to the smaller key. ``stats`` gets the number of donors whose distance was taken."""
        wanted = k + 1 if exclude_self else k
        queries = written(queries.select("_p", "_q", "_qv"), "queries")
        home = written(self._visits(queries.withColumn("_limit", F.lit(None).cast("double")), wanted, True), "visits")
        first = self._evaluate(home, wanted, exclude_self, stats)
        near = W.partitionBy("_p", "_q").orderBy("dist", "_d")
        best = written(first.withColumn("nn_rank", F.row_number().over(near)).where(F.col("nn_rank") <= k).drop("nn_rank"), "nearest")
        limit = best.groupBy("_p", "_q").agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).alias("_limit"))
        rest = written(self._visits(queries.join(limit, ["_p", "_q"], "left"), wanted, False), "visits")
        if not rest.isEmpty():
            every = best.unionByName(self._evaluate(rest, wanted, exclude_self, stats))
            best = written(every.withColumn("nn_rank", F.row_number().over(near)).where(F.col("nn_rank") <= k).drop("nn_rank"), "nearest")
        return best.withColumn("nn_rank", F.row_number().over(near))

    def _visits(self, queries: DataFrame, k: int, home: bool) -> DataFrame:
        """_p, _cell, _q, _qv, _leaves, _n: the leaves next to each query, or all others within its ``_limit`` (none: any
        distance), by cell; and how many donors they hold."""
        shared, width, scale, p, least = self.shared, self.width, self.scale, self.p, max(k, self.first)

        def chosen(boxes: Boxes, cells: Boxes, z: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Query and place of the leaf: all leaves of the nearest cells that hold ``least`` donors, or those within the
            limit in the other cells, whose boxes are tried first."""
            near, mid = cells.bounds(z, scale, p)
            score = np.where(np.isfinite(near), near + 0.01 * mid, np.inf)
            some = min(len(cells.n), 2 + 2 * int(least / cells.n.mean()))
            order = np.argpartition(score, some - 1, axis=1)[:, :some]
            order = np.take_along_axis(order, np.argsort(np.take_along_axis(score, order, 1), axis=1, kind="stable"), 1)
            before = np.cumsum(cells.n[order], axis=1) - cells.n[order]
            first = np.zeros(near.shape, bool)
            np.put_along_axis(first, order, before < least, axis=1)
            row, cell = np.nonzero((first if home else ~first & (near <= limit[:, None])) & np.isfinite(near))
            n = np.diff(np.append(cells.leaf, len(boxes.leaf)))[cell]  # leaves of each cell
            each = np.repeat(np.arange(len(row)), n)
            leaf = cells.leaf[cell[each]] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            row = row[each]
            keep = np.isfinite(b := boxes.pair_bounds(z[row], leaf, scale, p)) & (home | (b <= limit[row]))
            return row[keep], leaf[keep]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            plan = shared.value
            for b in batches:
                z = plan.place(matrix(b.column("_qv"), width))
                limit = b.column("_limit").to_numpy(zero_copy_only=False).astype(np.float64)
                limit = np.where(np.isnan(limit), np.inf, limit)
                for part, rows in _parts(b.column("_p")):
                    boxes = plan.boxes.get(part)
                    cells = boxes and boxes.cells()
                    step = max(1, CELLS // len(boxes.leaf)) if boxes else len(rows)
                    for at in range(0, len(rows), step):
                        some = rows[at:at + step]
                        if boxes:
                            row, col = chosen(boxes, cells, z[some], limit[some])
                            leaf, cell, n = boxes.leaf[col], boxes.cell[col], boxes.n[col]
                        else:  # a part without a tree is one leaf
                            row = np.arange(len(some) if home else 0)
                            leaf = cell = n = np.zeros(len(row), np.int64)
                        new = np.ones(len(row), bool)
                        new[1:] = (row[1:] != row[:-1]) | (cell[1:] != cell[:-1])
                        head = np.nonzero(new)[0]
                        take = pa.array(some[row[head]])
                        lists = pa.ListArray.from_arrays(pa.array(np.append(head, len(row)), pa.int32()), pa.array(leaf, pa.int32()))
                        held = np.add.reduceat(n, head) if len(head) else n
                        yield pa.RecordBatch.from_arrays([b.column("_p").take(take), pa.array(cell[head], pa.int32()), b.column("_q").take(take),
                                                          b.column("_qv").take(take), lists, pa.array(held, pa.int64())],
                                                         names=["_p", "_cell", "_q", "_qv", "_leaves", "_n"])

        fields = [queries.schema["_p"], T.StructField("_cell", T.IntegerType()), queries.schema["_q"], queries.schema["_qv"],
                  T.StructField("_leaves", T.ArrayType(T.IntegerType())), T.StructField("_n", T.LongType())]
        return queries.select("_p", "_q", "_qv", "_limit").mapInArrow(run, T.StructType(fields))

    def _evaluate(self, visits: DataFrame, k: int, exclude_self: bool, stats: dict | None) -> DataFrame:
        """_p, _q, _d, dist: of each block and query the k nearest in the leaves asked for."""
        if stats is not None:
            stats["candidates"] = stats.get("candidates", 0) + (visits.agg(F.sum("_n")).first()[0] or 0)
        # queries meet a block in batches; a cell that very many queries visit has as many batches as it takes
        many = visits.groupBy("_p", "_cell").agg(F.ceil(F.count(F.lit(1)) / BATCH).alias("_s"))
        salted = visits.join(many, ["_p", "_cell"]).withColumn("_salt", F.pmod(F.xxhash64("_q"), F.col("_s")))
        at = ["_p", "_cell", "_salt"]
        batches = salted.repartition(self.parts, *at).groupBy(*at).agg(F.collect_list(F.struct("_q", "_qv", "_leaves")).alias("_qs"))
        blocks = self.blocks.withColumnRenamed("_leaves", "_at").join(many, ["_p", "_cell"])
        blocks = blocks.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_s") - 1))).drop("_s")
        pairs = batches.join(blocks.repartition(self.parts, *at), at).select("_p", "_qs", "_keys", "_vec", "_at")
        width, scale, p = self.width, self.scale, self.p

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    qs, keys = b.column("_qs")[i].values, b.column("_keys")[i].values
                    d = np.frombuffer(b.column("_vec")[i].as_buffer(), np.float64).reshape(-1, width)
                    q, lists = matrix(qs.field("_qv"), width), qs.field("_leaves")
                    who = np.repeat(np.arange(len(qs)), np.diff(lists.offsets.to_numpy()))
                    row, col, dist = best_in_block(q, who, lists.flatten().to_numpy(), d, b.column("_at")[i].values.to_numpy(), k, scale, p)
                    yield pa.RecordBatch.from_arrays([b.column("_p").take(pa.array(np.full(len(row), i))), qs.field("_q").take(pa.array(row)),
                                                      keys.take(pa.array(col)), pa.array(dist)], names=["_p", "_q", "_d", "dist"])

        schema = T.StructType([visits.schema["_p"], visits.schema["_q"], T.StructField("_d", self.blocks.schema["_keys"].dataType.elementType),
                               T.StructField("dist", T.DoubleType())])
        found = pairs.mapInArrow(run, schema)
        return found.where(F.col("_q") != F.col("_d")) if exclude_self else found


def best_in_block(q: np.ndarray, who: np.ndarray, leaf: np.ndarray, d: np.ndarray, at: np.ndarray, k: int, scale: float,
                  p: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, donor and distance of the k best donors of each query in the leaves it asks for: ``who`` asks for ``leaf``,
    and ``at`` is each donor's leaf, in order."""
    order = np.argsort(leaf, kind="stable")
    who, leaf = who[order], leaf[order]
    rows, cols, dists = [], [], []
    for number in np.unique(at).tolist():
        lo, hi = np.searchsorted(at, number), np.searchsorted(at, number, side="right")
        asks = who[np.searchsorted(leaf, number):np.searchsorted(leaf, number, side="right")]
        step = max(1, CELLS // (hi - lo))
        for i in range(0, len(asks), step):
            some = asks[i:i + step]
            dist = distances(q[some], d[lo:hi], scale, p)
            row, col = nearest_in(dist, k)
            rows.append(some[row])
            cols.append(lo + col)
            dists.append(dist[row, col])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row, col, dist = np.concatenate(rows), np.concatenate(cols), np.concatenate(dists)
    order = np.lexsort((col, dist, row))  # equal distances of two leaves may be told apart by keys: all of them stay
    row, col, dist = row[order], col[order], dist[order]
    start = np.searchsorted(row, row)
    edge = dist[np.minimum(start + k - 1, np.searchsorted(row, row, side="right") - 1)]
    keep = dist <= edge
    return row[keep], col[keep], dist[keep]


def _parts(column: pa.Array) -> list[tuple[tuple, np.ndarray]]:
    """Rows of each value of the partition columns."""
    groups: dict = {}
    for i, part in enumerate(column.to_pylist()):
        groups.setdefault(tuple(part.values()), []).append(i)
    return [(part, np.array(rows)) for part, rows in groups.items()]


class Packer:
    """Rows in order of (_p, _cell, _leaf, _d) to blocks, and a row with the box of each leaf of a tree."""

    def __init__(self, width: int, block: int, plan: Plan):
        self.width, self.block, self.plan = width, block, plan
        self.at = self.box = None
        self.leaf, self.total = None, 0
        self.held: list = []
        self.made: list = []

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            self.kinds = (b.column("_p").type, b.column("_d").type)
            x = matrix(b.column("_dv"), self.width)
            leaf = b.column("_leaf").to_numpy()
            at = [(tuple(p.items()), c, n) for p, c, n in zip(b.column("_p").to_pylist(), b.column("_cell").to_pylist(), leaf.tolist())]
            bounds = [0, *(i for i in range(1, len(at)) if at[i] != at[i - 1]), len(at)]
            for lo, hi in zip(bounds, bounds[1:]):
                if (at[lo][:2], at[lo][2]) != (self.at, self.leaf):
                    self.end_leaf()
                    if at[lo][:2] != self.at:
                        self.end_block()
                    self.at, self.leaf, self.box, self.total = at[lo][:2], at[lo][2], None, 0
                self.add_box(x[lo:hi])
                while lo < hi:
                    have = sum(len(v) for _, v, _ in self.held)
                    end = min(hi, lo + self.block - have)
                    self.held.append((b.column("_d").slice(lo, end - lo), x[lo:end], leaf[lo:end]))
                    if have + end - lo == self.block:
                        self.end_block()
                    lo = end
            if len(self.made) >= 256:
                yield self.flush()
        self.end_leaf()
        self.end_block()
        if self.made:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        out = pa.Table.from_batches(self.made).combine_chunks().to_batches()[0]
        self.made = []
        return out

    def add_box(self, x: np.ndarray) -> None:
        z = self.plan.place(x)
        there = ~np.isnan(z)
        one = (np.where(there, z, np.inf).min(0), np.where(there, z, -np.inf).max(0), there.any(0), there.all(0))
        box = self.box
        self.box = one if box is None else (np.minimum(box[0], one[0]), np.maximum(box[1], one[1]), box[2] | one[2], box[3] & one[3])
        self.total += len(x)

    def row(self, n: int, keys: pa.Array | None, vec: bytes | None, leaves: list | None, leaf: int | None, box: list) -> pa.RecordBatch:
        p_type, k_type = self.kinds
        kinds = (p_type, pa.int32(), pa.int64(), pa.list_(k_type), pa.binary(), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.float64()),
                 pa.list_(pa.float64()), pa.list_(pa.bool_()), pa.list_(pa.bool_()))
        cols = [pa.array([v], t) for v, t in zip((dict(self.at[0]), self.at[1], n, None, vec, leaves, leaf, *box), kinds)]
        if keys is not None:
            cols[3] = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
        return pa.RecordBatch.from_arrays(cols, names=["_p", "_cell", "_n", "_keys", "_vec", "_leaves", "_leaf", "_low", "_high", "_any", "_all"])

    def end_leaf(self) -> None:
        if self.at and tuple(v for _, v in self.at[0]) in self.plan.trees:
            self.made.append(self.row(self.total, None, None, None, self.leaf, [c.tolist() for c in self.box]))

    def end_block(self) -> None:
        if self.held:
            keys, vec, leaf = zip(*self.held)
            x = np.concatenate(vec)
            self.made.append(self.row(len(x), pa.concat_arrays(keys), x.tobytes(), np.concatenate(leaf).tolist(), None, [None] * 4))
            self.held = []


def search(queries: DataFrame, donors: DataFrame, qkey: str, dkey: str, vec: str, k: int, width: int, part=(), exclude_self: bool = False,
           p: int | None = None, scale: float = 1.0, stats: dict | None = None, **sizes) -> DataFrame:
    """(part…, qkey, dkey, nn_rank, dist) for the k nearest donors of every query, among those with the same ``part`` values.
    ``sizes``: ``leaf``, ``block`` and ``first`` of ``BlockIndex``."""
    part = list(part)
    p_col = F.struct(*[F.col(c) for c in part]) if part else F.struct(F.lit(0).alias("one"))
    d = donors.select(p_col.alias("_p"), F.col(dkey).alias("_d"), F.col(vec).alias("_dv"))
    q = queries.select(p_col.alias("_p"), F.col(qkey).alias("_q"), F.col(vec).alias("_qv"))
    index = BlockIndex(d, width, k + 1 if exclude_self else k, p, scale, **sizes)
    found = index.nearest(q, k, exclude_self, stats)
    return found.select(*[F.col(f"_p.{c}").alias(c) for c in part], F.col("_q").alias(qkey), F.col("_d").alias(dkey), "nn_rank", "dist")
