"""Exact k nearest neighbours on one coordinate, for imputation of two columns.

With one other column a donor is a number. Donors and recipients are dealt over
chunks of the line, whose bounds are quantiles of the donors; a chunk also gets
the donors next to it, so a task that sorts them answers its recipients alone.
Both columns share one exchange, whose rows are packed values, not single ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tessera.session import written

#: Rows that a task packs at a time, donors and recipients of a chunk, chunks of a column at most, and quantiles of the recipients.
HELD, CHUNK, ASKED, CHUNKS, STEPS = 1 << 19, 1 << 16, 1 << 18, 1 << 13, 512
#: Slots (chunks, or parts of a chunk that very many recipients ask) of a task.
SLOTS = 8


def distance(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Nan-Euclidean distances of rows of two columns that have one in common, as ``neighbours.distances`` has them."""
    with np.errstate(over="ignore", invalid="ignore"):
        d = q - v
        d *= d
        np.minimum(d, np.finfo(np.float64).max, out=d)
        np.copyto(d, 0.0, where=np.isnan(d))
        return np.sqrt(2.0 * d)


def places(key: pa.Array) -> np.ndarray:
    """Numbers in the order of the keys, nulls first."""
    if pa.types.is_integer(key.type) and not key.null_count:
        return key.to_numpy()
    return pc.rank(key, null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)


def least(v: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Rows in order of (value, key), of each value the k least keys."""
    order = np.lexsort((place, v))
    x = v[order]
    head = np.nonzero(np.append(True, x[1:] != x[:-1])[:len(x)])[0]
    return order[np.arange(len(x)) - np.repeat(head, np.diff(np.append(head, len(x)))) < k]


def spans(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers from each ``lo`` to before its ``hi``, one span after the other."""
    n = hi - lo
    return np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)


class Line:
    """Donors of a chunk and next to it, in order of (value, key)."""

    def __init__(self, v: np.ndarray, keys: pa.Array, s: np.ndarray, n: np.ndarray, k: int, low: float, high: float):
        place = places(keys)
        at = least(v, place, k)
        self.v, self.place, self.s, self.n, self.at, self.keys, self.k = v[at], place[at], s[at], n[at], at, keys, k
        # beyond the second k donors outside of a bound there may be more, which other chunks have
        left, right = np.searchsorted(self.v, [low, high])
        self.ends = [self.v[left - 2 * k]] if left >= 2 * k else []
        self.ends += [self.v[right + 2 * k - 1]] if len(self.v) - right >= 2 * k else []

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Query, donor and distance of the k nearest donors, ties to the smaller key; and which queries other chunks may answer better."""
        k, n = self.k, len(self.v)
        at = np.searchsorted(self.v, q)[:, None] + np.arange(-2 * k, 2 * k)
        there = (at >= 0) & (at < n)
        np.clip(at, 0, max(0, n - 1), out=at)
        dist = np.where(there, distance(q[:, None], self.v[at]), np.inf) if n else np.full(at.shape, np.inf)
        edge = np.partition(dist, k - 1, axis=1)[:, k - 1]
        open_ = np.zeros(len(q), bool)
        for end in self.ends:
            d = distance(q, np.float64(end))
            open_ |= np.isfinite(d) & (d <= edge)
        near = (dist <= edge[:, None]) & np.isfinite(dist)
        wide = near[:, 0] | near[:, -1]  # equal distances beyond what was looked at
        near[wide] = False
        row, col = np.nonzero(near)
        donor, dist = at[row, col], dist[row, col]
        for i in np.nonzero(wide)[0]:
            d = distance(q[i], self.v)
            some = np.nonzero((d <= edge[i]) & np.isfinite(d))[0]
            row, donor, dist = np.append(row, np.full(len(some), i)), np.append(donor, some), np.append(dist, d[some])
        count = np.bincount(row, minlength=len(q))
        tied = count[row] > k
        if tied.any():
            some = np.nonzero(tied)[0]
            some = some[np.lexsort((self.place[donor[some]], dist[some], row[some]))]
            first = np.searchsorted(row[some], row[some])
            keep = np.concatenate([np.nonzero(~tied)[0], some[np.arange(len(some)) - first < k]])
            row, donor, dist = row[keep], donor[keep], dist[keep]
        return row, donor, dist, open_


def _packed(key_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("v", T.BinaryType()),
                         T.StructField("s", T.BinaryType()), T.StructField("n", T.BinaryType()), T.StructField("keys", T.ArrayType(key_type))])


def _numbers(b: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    c = b.column(name)
    return (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c).to_numpy(zero_copy_only=False).astype(np.float64)


def _pack(held: list, kinds: tuple, bounds: list, salts: list, k: int) -> pa.RecordBatch:
    """Donors (kind 0) and recipients (1, or 2 where their key repeats) of both columns by slot."""
    table = pa.Table.from_batches(held)
    key = table.column("_key").combine_chunks()
    key = pa.concat_arrays(key.chunks) if isinstance(key, pa.ChunkedArray) else key
    null, place = key.is_null().to_numpy(zero_copy_only=False), places(key)
    value = [_numbers(table, "_x0"), _numbers(table, "_x1")]
    many = table.column("_many").to_numpy() if "_many" in table.column_names else None
    slots, kind, columns, take, ends = [], [], [], [], [0]

    def add(slot: np.ndarray, what: int, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, *numbers: np.ndarray) -> None:
        for i, a, b in zip(slot.tolist(), lo.tolist(), hi.tolist()):
            if a < b:
                slots.append(i)
                kind.append(what)
                columns.append([x[rows[a:b]].tobytes() if len(x) else b"" for x in numbers])
                take.append(rows[a:b])
                ends.append(ends[-1] + b - a)

    begin = 0
    for t in (0, 1):
        mine, v = value[t], value[1 - t]
        each, none = salts[t], np.zeros(0)
        first = begin + np.cumsum(each) - each  # slot of each chunk
        begin += int(each.sum())
        if "donors" in kinds:
            rows = np.nonzero(~np.isnan(mine) & ~np.isnan(v))[0]
            rows = rows[least(v[rows], place[rows], k)]
            cut = np.searchsorted(v[rows], bounds[t])
            lo, hi = np.maximum(np.append(0, cut) - 2 * k, 0), np.minimum(np.append(cut, len(rows)) + 2 * k, len(rows))
            chunk = np.repeat(np.arange(len(each)), each)
            s, n = mine, np.where(null, 0, 1).astype(np.int64) if null.any() else none
            if f"_s{t}" in table.column_names:
                n = _numbers(table, f"_n{t}")
                s, n = np.where(np.isnan(n), mine, _numbers(table, f"_s{t}")), np.where(null, 0, np.nan_to_num(n, nan=1.0)).astype(np.int64)
            add(np.arange(begin - int(each.sum()), begin), 0, rows, lo[chunk], hi[chunk], v, np.where(null, 0.0, s), n)
        if "recipients" in kinds:
            for what in (1, 2) if many is not None else (1,):
                rows = np.nonzero(np.isnan(mine) & ~np.isnan(v) & ~null & (True if many is None else many == (what == 2)))[0]
                chunk = np.searchsorted(bounds[t], v[rows], side="right")
                slot = first[chunk] + np.arange(len(rows)) % each[chunk]
                order = np.argsort(slot, kind="stable")
                number, at = np.unique(slot[order], return_index=True)
                add(number, what, rows[order], at, np.append(at[1:], len(rows)), v, none, none)
    keys = key.take(pa.array(np.concatenate(take) if take else np.zeros(0, np.int64)))
    v, s, n = zip(*columns) if columns else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(kind, pa.int32()), *(pa.array(c, pa.binary()) for c in (v, s, n)),
                                       pa.ListArray.from_arrays(pa.array(ends, pa.int32()), keys)], names=["slot", "kind", "v", "s", "n", "keys"])


def _answers(batches: Iterator[pa.RecordBatch], bounds: list, salts: list, k: int) -> Iterator[pa.RecordBatch]:
    """Rows by (slot, kind) to column, key, sum and number of the k nearest donors' values, or the donors where the key repeats."""
    column = np.repeat([0, 1], [int(s.sum()) for s in salts])
    low = np.concatenate([np.repeat(np.append(-np.inf, b), s) for b, s in zip(bounds, salts)])
    high = np.concatenate([np.repeat(np.append(b, np.inf), s) for b, s in zip(bounds, salts)])
    now, held, line = None, [], None
    for b in batches:
        keys_type = b.column("keys").type.value_type
        for i in range(b.num_rows):
            slot, kind = b.column("slot")[i].as_py(), b.column("kind")[i].as_py()
            v, s, n = (np.frombuffer(b.column(c)[i].as_buffer(), d) for c, d in (("v", np.float64), ("s", np.float64), ("n", np.int64)))
            keys = b.column("keys")[i].values
            if slot != now:
                now, held, line = slot, [], None
            if kind == 0:
                held.append((v, keys, s, n if len(n) else np.ones(len(v), np.int64)))
                continue
            if line is None:
                dv, dk, ds, dn = zip(*held) if held else ([np.zeros(0)], [pa.array([], keys_type)], [np.zeros(0)], [np.zeros(0, np.int64)])
                line, held = Line(np.concatenate(dv), pa.concat_arrays(dk), np.concatenate(ds), np.concatenate(dn), k, low[slot], high[slot]), []
            for at in range(0, len(v), 1 << 16):
                q = v[at:at + (1 << 16)]
                row, donor, dist, open_ = line.nearest(q)
                near = pa.nulls(len(q), pa.list_(pa.struct([("dist", pa.float64()), ("d", keys_type), ("s", pa.float64()), ("n", pa.int64())])))
                if kind == 2:
                    order = np.argsort(row, kind="stable")
                    pick = donor[order]
                    flat = pa.StructArray.from_arrays([pa.array(dist[order]), line.keys.take(pa.array(line.at[pick])), pa.array(line.s[pick]), pa.array(line.n[pick])],
                                                      names=["dist", "d", "s", "n"])
                    near = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[order], np.arange(len(q) + 1)), pa.int32()), flat)
                sums = np.bincount(row, line.s[donor], len(q)), np.bincount(row, line.n[donor], len(q)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), column[slot], np.int32)), keys.slice(at, len(q)), *(pa.array(x) for x in sums),
                                                  pa.array(open_), near], names=["t", "key", "s", "n", "open", "near"])


def _repeated(rows: DataFrame, key: str, x: list) -> DataFrame | None:
    """Sums and numbers of the donors' values by key, of keys that repeat; None if none does."""
    many = written(rows.groupBy(key).count().where("count > 1").select(key), "repeated")
    if many.isEmpty():
        return None
    pair = [F.when(x[1 - t].isNotNull(), x[t]) for t in (0, 1)]
    return written(rows.join(many, key, "left_semi").groupBy(key).agg(*[a for t in (0, 1) for a in (F.coalesce(F.sum(pair[t]), F.lit(0.0)).alias(f"_s{t}"), F.count(pair[t]).alias(f"_n{t}"))]), "repeated")


def fills(rows: DataFrame, key: str, cols: list, k: int, donors: DataFrame | None = None) -> DataFrame | None:
    """(key, ``_imp_`` of both columns): the mean of a missing value's k nearest donors by the other column, ties to the smaller
    key, for every key with such a value. ``donors`` (default: the rows themselves) have the columns too; both are read several
    times. None where the general search is needed: equal distances reach beyond a chunk's neighbours, or the keys' kinds differ.

    As there, rows of one key share the k least of their neighbours, and a neighbour counts with all donors of its key."""
    spark, x = rows.sparkSession, [F.col(c).cast("double") for c in cols]
    source = rows if donors is None else donors
    if source.schema[key].dataType != rows.schema[key].dataType:
        return None
    asks = [x[t].isNull() & x[1 - t].isNotNull() & F.col(key).isNotNull() for t in (0, 1)]
    gives = x[0].isNotNull() & x[1].isNotNull()
    asked = rows.agg(*[F.count(F.when(a, 1)).alias(f"r{t}") for t, a in enumerate(asks)]).first()
    n = source.where(gives).count()
    wanted = min(CHUNKS, max(1, -(-n // CHUNK)))
    part = lambda m: F.array(*[F.lit(i / m) for i in range(1, m)])
    bounds, salts = [np.zeros(0)] * 2, [np.ones(1, np.int64)] * 2
    if wanted > 1:
        cuts = source.where(gives).agg(*[F.percentile_approx(x[1 - t], part(wanted), max(10_000, 8 * wanted)).alias(f"c{t}") for t in (0, 1)]).first()
        bounds = [np.unique(np.array(cuts[f"c{t}"], np.float64)) for t in (0, 1)]
    if max(asked) > ASKED and wanted > 1:  # how many recipients a chunk has, from their quantiles
        steps = rows.agg(*[F.percentile_approx(F.when(a, x[1 - t]), part(STEPS), 10_000).alias(f"c{t}") for t, a in enumerate(asks)]).first()
    else:
        steps = None
    for t in (0, 1):
        many = np.full(len(bounds[t]) + 1, asked[t] if wanted == 1 else 0)
        if steps is not None and steps[f"c{t}"]:
            many = np.bincount(np.searchsorted(bounds[t], steps[f"c{t}"], side="right"), minlength=len(bounds[t]) + 1) * (asked[t] / STEPS)
        salts[t] = np.maximum(1, np.ceil(many / ASKED)).astype(np.int64)
    plan = spark.sparkContext.broadcast((bounds, salts))

    def frame(df: DataFrame, kinds: tuple) -> DataFrame:
        keep = [F.col(key).alias("_key"), x[0].alias("_x0"), x[1].alias("_x1")]
        again = _repeated(df, key, x)
        if again is not None:
            df = df.join(again, key, "left")
            keep += [F.col("_n0").isNotNull().alias("_many"), *(F.col(f"_{c}{t}").cast("double").alias(f"_{c}{t}") for t in (0, 1) for c in "sn")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bounds, salts = plan.value
            held, size = [], 0
            for b in batches:
                held.append(b)
                size += b.num_rows
                if size >= HELD:
                    yield _pack(held, kinds, bounds, salts, k)
                    held, size = [], 0
            if size:
                yield _pack(held, kinds, bounds, salts, k)

        return df.select(*keep).mapInArrow(run, _packed(df.schema[key].dataType))

    if donors is None:
        packed = frame(rows, ("donors", "recipients"))
    else:
        packed = frame(rows, ("recipients",)).unionByName(frame(donors.select(F.col(key), *[F.col(c) for c in cols]), ("donors",)))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _answers(batches, *plan.value, k)

    kind = T.StructType([T.StructField("dist", T.DoubleType()), T.StructField("d", source.schema[key].dataType), T.StructField("s", T.DoubleType()), T.StructField("n", T.LongType())])
    schema = T.StructType([T.StructField("t", T.IntegerType()), T.StructField("key", rows.schema[key].dataType), T.StructField("s", T.DoubleType()),
                           T.StructField("n", T.LongType()), T.StructField("open", T.BooleanType()), T.StructField("near", T.ArrayType(kind))])
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(int(s.sum()) for s in salts) // SLOTS)
    found = written(packed.repartition(tasks, "slot").sortWithinPartitions("slot", "kind").mapInArrow(solve, schema), "line")
    seen = found.agg(F.max("open"), F.max(F.col("near").isNotNull())).first()
    if seen[0]:
        return None
    one = found.where("near IS NULL").select("t", "key", "s", "n")
    if seen[1]:
        each = found.where("near IS NOT NULL").select("t", "key", F.explode("near").alias("e")).select("t", "key", "e.*")
        best = each.withColumn("_r", F.row_number().over(W.partitionBy("t", "key").orderBy("dist", "d"))).where(F.col("_r") <= k)
        one = one.unionByName(best.groupBy("t", "key").agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
    mean = F.when(F.col("n") > 0, F.col("s") / F.col("n"))
    return one.groupBy(F.col("key").alias(key)).agg(*[F.max(F.when(F.col("t") == t, mean)).alias(f"_imp_{c}") for t, c in enumerate(cols)])
