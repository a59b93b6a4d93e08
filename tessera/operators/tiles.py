"""Exact nan-Euclidean neighbours for imputation of many columns (C3), by tiles.

The distance of a row to a donor is the same for every column that the row
lacks, so one search serves all of them. Queries and donors are put in order of
a tree of median splits and packed; a task holds one group of donors and meets
queries a tile at a time: one matrix product tells which pairs may be among the
nearest, with a bound on its rounding, and only those get their distance. Tiles
whose box is beyond the distances found so far are left out. Pairs never become
rows; of each query, column and group of donors the k best leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tessera.operators.line import places
from tessera.operators.neighbours import ROWS, SAMPLE, Boxes, Tree, distances, matrix, nearest_in
from tessera.session import written

#: Rows and donors of a tile, donors of a leaf, of a first look and of a group, which a task holds, and queries of a task.
TILE, LEAF, LOOK, GROUP, ASKED = 1024, 256, 256, 1 << 18, 1 << 15
#: Hits a query that wait at most, and numbers whose squares single precision holds.
WAIT, LARGE = 8, 1e15
UNIT = float(np.finfo(np.float32).eps)


def exact(q: np.ndarray, d: np.ndarray, p: int) -> np.ndarray:
    """Distances of single pairs, row by row, as ``neighbours.distances`` has them."""
    acc, common = np.zeros(len(q)), np.zeros(len(q))
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        for j in range(q.shape[1]):
            diff = q[:, j] - d[:, j]
            diff *= diff
            np.minimum(diff, np.finfo(np.float64).max, out=diff)
            np.copyto(diff, 0.0, where=np.isnan(diff))
            acc += diff
            common += ~np.isnan(q[:, j]) & ~np.isnan(d[:, j])
        return np.where(common > 0, np.sqrt(p / common * acc), np.inf)


class Donors:
    """One group of donors, in tiles with their boxes."""

    def __init__(self, x: np.ndarray, keys: pa.Array, p: int, k: int):
        self.x, self.keys, self.place, self.p, self.k = x, keys, places(keys), p, k
        self.there = ~np.isnan(x)
        heads = np.arange(0, len(x), TILE)
        of = lambda f, v: f.reduceat(v, heads, axis=0)
        self.boxes = Boxes(heads, heads, of(np.minimum, np.where(self.there, x, np.inf)), of(np.maximum, np.where(self.there, x, -np.inf)),
                           of(np.logical_or, self.there), of(np.logical_and, self.there), np.diff(np.append(heads, len(x))))
        # of a column that few have, all donors are met at once, and none is waited for
        held = self.there.sum(0)
        self.rare = [t for t in range(x.shape[1]) if held[t] <= LOOK]

    def nearest(self, q: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each column the query, donor and distance of the k nearest donors that have it, of the queries that lack it."""
        gone = np.isnan(q)
        self.q, self.gone, self.waiting, self.size = q, gone, [], 0
        self.best = {t: (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)) for t in range(q.shape[1]) if gone[:, t].any()}
        self.often = [t for t in self.best if t not in self.rare]
        self.kth = {t: np.where(gone[:, t], np.inf, -1.0) for t in self.often}
        for t in self.best:
            if t in self.rare and len(some := np.nonzero(self.there[:, t])[0]):
                ask = np.nonzero(gone[:, t])[0]
                dist = distances(q[ask], self.x[some], 1.0, self.p)
                row, col = np.nonzero(np.isfinite(dist))
                self.keep(t, ask[row], some[col], dist[row, col])
        if self.often:
            with np.errstate(over="ignore", invalid="ignore"):
                near, mid = self.boxes.bounds(q, 1.0, self.p)
            near = np.nan_to_num(near, nan=0.0)
            asks = gone[:, self.often].any(1)
            order = np.argsort(np.where(np.isfinite(near), near + 0.01 * np.nan_to_num(mid, nan=0.0, posinf=0.0), 1e300)[asks].mean(0), kind="stable")
            self.look(np.nonzero(asks)[0], self.boxes.leaf[order[0]], min(LOOK, self.boxes.n[order[0]]))
            for i in order:
                lo, hi = self.boxes.leaf[i], self.boxes.leaf[i] + self.boxes.n[i]
                if i == order[0]:
                    lo = min(lo + LOOK, hi)
                rows = np.nonzero(near[:, i] <= self.limit)[0]
                if len(rows) and lo < hi:
                    self.meet(rows, lo, hi)
                    if self.size > WAIT * len(q):
                        self.settle()
            self.settle()
        for t, (row, donor, dist) in self.best.items():
            yield t, row, donor, dist

    def look(self, rows: np.ndarray, lo: int, n: int) -> None:
        """The k nearest of a few donors, from which the first limits come."""
        some = lo + np.argsort(self.place[lo:lo + n], kind="stable")  # ties go to the first
        dist = distances(self.q[rows], self.x[some], 1.0, self.p)
        for t in self.often:
            ask, have = np.nonzero(self.gone[rows, t])[0], np.nonzero(self.there[some, t])[0]
            if len(ask) and len(have):
                part = dist[np.ix_(ask, have)]
                row, col = nearest_in(part, self.k)
                self.best[t] = (rows[ask[row]], some[have[col]], part[row, col])
        self.settle()

    def meet(self, rows: np.ndarray, lo: int, hi: int) -> None:
        """Pairs of a tile that may be within the queries' limits."""
        limit = self.limit[rows]
        if 0 < (known := np.isfinite(limit)).sum() < len(rows):
            self.meet(rows[known], lo, hi)
            self.meet(rows[~known], lo, hi)
            return
        q, d = self.q[rows], self.x[lo:hi]
        with np.errstate(all="ignore"):
            bound = limit ** 2 / self.p * (1 + 1e-9)
            ma, mb = ~np.isnan(q), ~np.isnan(d)
            centre = np.where(ma, q, 0.0).sum(0) / np.maximum(ma.sum(0), 1)
            a, b = np.where(ma, q - centre, 0.0), np.where(mb, d - centre, 0.0)
            plain = max(np.abs(a).max(), np.abs(b).max(), np.abs(centre).max(), bound.max()) < LARGE
        if plain:
            # squares of differences less the limit, over common coordinates, less what rounding may add; centring rounds values, not differences
            width, aa, bb = a.shape[1], (a * a).sum(1), (b * b).sum(1)
            slack = 128 * UNIT * (aa + bound * width) + 1e-30
            left = np.concatenate([a * a - bound[:, None] * ma, ma, -2 * a, -slack[:, None], np.full((len(a), 1), -1.0)], axis=1, dtype=np.float32, casting="same_kind")
            right = np.concatenate([mb, b * b, b, np.ones((len(b), 1)), (128 * UNIT * bb)[:, None]], axis=1, dtype=np.float32, casting="same_kind")
            hit = np.flatnonzero(left @ right.T <= 0.0)
            row, col = np.divmod(hit, len(b))
            dist = exact(q[row], d[col], self.p)
        else:
            every = distances(q, d, 1.0, self.p)
            row, col = np.nonzero(every <= limit[:, None])
            dist = every[row, col]
        some = np.nonzero((dist <= limit[row]) & np.isfinite(dist))[0]
        if len(some):
            self.waiting.append((rows[row[some]], lo + col[some], dist[some]))
            self.size += len(some)

    def settle(self) -> None:
        """The k best of what waits, by column, and new limits: the farthest of a query's k-th distances."""
        if self.waiting:
            row, donor, dist = (np.concatenate(c) for c in zip(*self.waiting))
            for t in self.often:
                some = np.nonzero((dist <= self.kth[t][row]) & self.there[donor, t])[0]
                self.keep(t, row[some], donor[some], dist[some])
        self.waiting, self.size = [], 0
        for t in self.often:
            row, _, dist = self.best[t]
            full = np.nonzero(np.bincount(row, minlength=len(self.q)) == self.k)[0]
            self.kth[t][full] = dist[np.searchsorted(row, full, side="right") - 1]
        self.limit = np.max([self.kth[t] for t in self.often], axis=0)

    def keep(self, t: int, row: np.ndarray, donor: np.ndarray, dist: np.ndarray) -> None:
        row, donor, dist = (np.concatenate(c) for c in zip(self.best[t], (row, donor, dist)))
        order = np.lexsort((self.place[donor], dist, row))
        row = row[order]
        first = order[np.arange(len(row)) - np.searchsorted(row, row) < self.k]
        row = np.sort(row[np.arange(len(row)) - np.searchsorted(row, row) < self.k])
        self.best[t] = (row, donor[first], dist[first])


def fills(rows: DataFrame, key: str, cols: list, k: int, donors: DataFrame | None = None) -> DataFrame | None:
    """(key, ``_imp_`` of the columns): the mean of a missing value's k nearest donors by the other columns, ties to the smaller
    key. ``donors`` (default: the rows themselves) have the columns too; both are read several times. None if the keys' kinds differ.

    Rows of one key share the k least of their neighbours, and a neighbour counts with all donors of its key."""
    spark, width = rows.sparkSession, len(cols)
    source = rows if donors is None else donors
    if source.schema[key].dataType != rows.schema[key].dataType:
        return None
    vec = F.array(*[F.col(c).cast("double") for c in cols])
    some = F.coalesce(*[F.col(c).cast("double") for c in cols]).isNotNull()
    lacks = F.greatest(*[F.col(c).isNull() for c in cols])
    asked = rows.where(lacks & some & F.col(key).isNotNull()).select(F.col(key).alias("_q"), vec.alias("_v"))
    # of donors that agree in all columns only the k least keys can be chosen: limited in each task before the exchange
    same = W.partitionBy("_v").orderBy("_q")
    given = written(source.where(some).select(F.col(key).alias("_q"), vec.alias("_v")).withColumn("_r", F.row_number().over(same))
                    .where(F.col("_r") <= k).drop("_r"), "donors")
    n, m = given.count(), asked.count()
    size = max(1024, min(ROWS, SAMPLE // width))
    sample = given if n <= size else given.where(F.pmod(F.xxhash64(F.lit("tiles"), "_q"), F.lit(1 << 40)) < int(size / n * (1 << 40)))
    z = np.array([r["_v"] for r in sample.select("_v").collect()], np.float64).reshape(-1, width)
    tree = spark.sparkContext.broadcast(Tree.grow(z, max(2, round(LEAF * min(1.0, size / max(1, n)))), 1))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = tree.value.leaf_of(matrix(b.column("_v"), width))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], names=["_q", "_v", "_leaf"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for b in batches:
            for at in range(0, b.num_rows, TILE):
                keys, v = b.column("_q").slice(at, TILE), matrix(b.column("_v").slice(at, TILE), width)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([v.tobytes()], pa.binary()),
                                                  pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)], names=["part", "number", "v", "keys"])
                number += 1

    key_type = source.schema[key].dataType
    field = lambda name, kind: T.StructField(name, kind)
    schema = T.StructType([field("part", T.IntegerType()), field("number", T.IntegerType()), field("v", T.BinaryType()), field("keys", T.ArrayType(key_type))])

    def packed(df: DataFrame, parts: int, tag: str) -> DataFrame:
        placed = df.mapInArrow(place, T.StructType([field("_q", key_type), field("_v", T.ArrayType(T.DoubleType())), field("_leaf", T.IntegerType())]))
        return written(placed.repartitionByRange(parts, "_leaf", "_q").sortWithinPartitions("_leaf", "_q").mapInArrow(pack, schema), tag)

    groups, tasks = max(1, -(-n // GROUP)), int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, -(-m // ASKED), min(-(-4 * tasks // groups), -(-m // TILE)))
    parts = -(-max(groups, min(tasks, -(-n // TILE))) // groups) * groups  # several of neighbouring ranges make a group
    gives = packed(given, parts, "tiles").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(
        (F.floor(F.col("part") / (parts // groups)) * salts + F.col("salt")).cast("int").alias("slot"), F.lit(0).alias("kind"), "part", "number", "v", "keys")
    asks = packed(asked, max(1, min(tasks, -(-m // TILE))), "tiles").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select(
        (F.col("group") * salts + F.pmod(F.col("part") + F.col("number") * 7919, F.lit(salts))).alias("slot"), F.lit(1).alias("kind"), "part", "number", "v", "keys")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, group = None, [], None
        for b in batches:
            for slot, kind, v, keys in zip(b.column("slot").to_pylist(), b.column("kind").to_pylist(), b.column("v"), b.column("keys")):
                x = np.frombuffer(v.as_buffer(), np.float64).reshape(-1, width)
                if slot != now:
                    now, held, group = slot, [], None
                if kind == 0:
                    held.append((x, keys.values))
                    continue
                if group is None and held:
                    group, held = Donors(np.concatenate([x for x, _ in held]), pa.concat_arrays([d for _, d in held]), width, k), []
                for t, row, donor, dist in group.nearest(x) if group else ():
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), t, np.int32)), keys.values.take(pa.array(row)), group.keys.take(pa.array(donor)), pa.array(dist)],
                                                     names=["t", "key", "d", "dist"])

    out = T.StructType([field("t", T.IntegerType()), field("key", key_type), field("d", key_type), field("dist", T.DoubleType())])
    found = gives.unionByName(asks).repartition(max(tasks, groups * salts), "slot").sortWithinPartitions("slot", "kind", "part", "number").mapInArrow(search, out)
    near = written(found, "near")
    best = near.withColumn("_r", F.row_number().over(W.partitionBy("t", "key").orderBy("dist", "d"))).where(F.col("_r") <= k)
    # a donor's value counts where it has another one as well
    values = source.where(some).select(F.col(key).alias("d"), vec.alias("_v"))
    value = F.col("_v").getItem(F.col("t"))
    joined = best.join(values, "d").where(value.isNotNull() & (F.size(F.filter("_v", lambda x: x.isNotNull())) > 1))
    mean = joined.groupBy("t", "key").agg(F.avg(value).alias("mean"))
    return mean.groupBy(F.col("key").alias(key)).agg(*[F.max(F.when(F.col("t") == t, F.col("mean"))).alias(f"_imp_{c}") for t, c in enumerate(cols)])
