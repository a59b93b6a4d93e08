"""Mutual information of continuous features with a class, by nearest neighbours.

For each row the distance to the k-th neighbour of its own class along one
feature is compared with how many rows of any class lie nearer:
ψ(N) + <ψ(k)> − <ψ(n_class)> − <ψ(m)>, negative values as 0, where m counts the
row itself. Rows of a class of one do not count, and k is n_class − 1 where
that is less. A row that has k equals in its class has distance 0; it counts
its equals, in its class for k and in all for m, so that features with few
values (one-hot ones) get the plug-in estimate, where a library would break ties by noise.

Values go to a grid of 1e-8 standard deviations: distances are whole numbers,
and equal gaps are equal whatever the arithmetic that scaled them.

Rows fold to distinct (feature, class, value) with counts before any exchange.
Each feature is cut into sorted chunks of bounded size, one row a chunk. The
last values of a class before a chunk and the first after it, by a window over
the chunks' edges, complete its neighbourhoods; a range that leaves its chunk
asks the chunks in which it ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.operators.rank import ordered_rank
from tessera.session import written

GRID = 1e-8
#: Distinct values in a chunk, and range ends that meet a chunk at a time.
CHUNK, BATCH = 250_000, 50_000
_FAR = np.iinfo(np.int64).max


def digamma(n: np.ndarray) -> np.ndarray:
    """ψ of positive whole numbers."""
    x = np.asarray(n, np.float64)
    shift = np.zeros_like(x)
    small = x < 10
    y = np.where(small, x + 10, x)
    for j in range(10):
        shift += np.where(small, 1 / (x + j), 0.0)
    z = 1 / (y * y)
    return np.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z / 132)))) - shift


def neighbour_distance(v: np.ndarray, w: np.ndarray, k: int, left: list, right: list) -> np.ndarray:
    """Distance from each of the ascending distinct values ``v`` (``w`` rows each) to its k-th neighbour among them and the
    (value, rows) next to them on either side."""
    pad = [(0, 0)] * k
    before, after = [*pad, *left][-k:], [*right, *pad][:k]
    value, rows = (np.concatenate([[p[j] for p in before], x, [p[j] for p in after]]).astype(np.int64) for j, x in ((0, v), (1, w)))
    here = np.arange(k, k + len(v))
    dist = np.stack([np.where(rows[here + o] > 0, np.abs(value[here + o] - v), _FAR) for o in range(-k, k + 1)])
    count = np.stack([rows[here + o] - (o == 0) for o in range(-k, k + 1)])
    order = np.argsort(dist, axis=0, kind="stable")
    held = np.cumsum(np.take_along_axis(count, order, 0), axis=0)
    return np.take_along_axis(np.take_along_axis(dist, order, 0), (held >= k).argmax(0)[None], 0)[0]


def _ints(blob) -> np.ndarray:
    return np.frombuffer(blob, np.int64)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (fi, chunk, q, c) to one row a chunk: q, c, k, w as arrays of bytes, and the rows in it."""
    names = ["fi", "chunk", "q", "c", "k", "w"]
    now, held = None, []

    def emit() -> pa.RecordBatch:
        cols = [np.concatenate(x) for x in zip(*held)]
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in cols),
                                           pa.array([int(cols[3].sum())], pa.int64())], names=[*names, "rows"])

    for b in batches:
        fi, chunk = b.column("fi").to_numpy(), b.column("chunk").to_numpy()
        bounds = [0, *(np.nonzero((fi[1:] != fi[:-1]) | (chunk[1:] != chunk[:-1]))[0] + 1).tolist(), len(fi)]
        for lo, hi in zip(bounds, bounds[1:]):
            if lo == hi:
                continue
            if (fi[lo], chunk[lo]) != now:
                if held:
                    yield emit()
                now, held = (fi[lo], chunk[lo]), []
            held.append([b.column(c).slice(lo, hi - lo).to_numpy().astype(np.int64) for c in names[2:]])
    if held:
        yield emit()


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """fi, c, chunk, and the first and last values (with their rows) of each class in a chunk."""
    for b in batches:
        for fi, chunk, q, c, k, w in zip(*(b.column(n).to_pylist() for n in ("fi", "chunk", "q", "c", "k", "w"))):
            q, c, k, w = map(_ints, (q, c, k, w))
            order = np.argsort(c, kind="stable")
            heads = np.nonzero(np.append(True, c[order][1:] != c[order][:-1]))[0]
            rows = []
            for lo, hi in zip(heads.tolist(), [*heads[1:].tolist(), len(c)]):
                at = order[lo:hi]
                n = int(k[at[0]])
                pairs = lambda idx: [{"v": int(q[i]), "n": int(w[i])} for i in idx.tolist()]  # noqa: B023, E731
                rows.append((fi, int(c[at[0]]), chunk, pairs(at[:n]), pairs(at[-n:])))
            pair = pa.list_(pa.struct([("v", pa.int64()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pair, pair))],
                                             names=["fi", "c", "chunk", "first", "last"])


def _ranges(bounds: dict, k_most: int):
    """For each chunk the sum of w (ψ(k) − ψ(m)) over the ranges that end in it, and the ends of the others as questions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                fi, chunk = b.column("fi")[i].as_py(), b.column("chunk")[i].as_py()
                q, c, k, w = (_ints(b.column(n)[i].as_py()) for n in ("q", "c", "k", "w"))
                near = {r["c"]: ([(p["v"], p["n"]) for p in r["left"] or []], [(p["v"], p["n"]) for p in r["right"] or []])
                        for r in b.column("around")[i].as_py()}
                radius, own = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
                order = np.argsort(c, kind="stable")
                heads = np.nonzero(np.append(True, c[order][1:] != c[order][:-1]))[0]
                for lo, hi in zip(heads.tolist(), [*heads[1:].tolist(), len(c)]):
                    at = order[lo:hi]
                    radius[at] = neighbour_distance(q[at], w[at], int(k[at[0]]), *near[int(c[at[0]])])
                own = np.where(radius > 0, k, w)  # equals in the class, where the distance is 0
                before = np.concatenate([[0], np.cumsum(w)])
                # values above q - r and below q + r; of distance 0: the equals
                low, high = np.where(radius > 0, q - radius + 1, q), np.where(radius > 0, q + radius, q + 1)
                edge = bounds[fi]
                in_low, in_high = (np.searchsorted(edge, t, side="right") for t in (low, high - 1))
                m = before[np.searchsorted(q, high)] - before[np.searchsorted(q, low)]
                inside = (in_low == chunk) & (in_high == chunk)
                total = float((w[inside] * (digamma(own[inside]) - digamma(m[inside]))).sum())
                ask = np.nonzero(~inside)[0]
                n = len(ask)
                null = pa.nulls
                yield pa.RecordBatch.from_arrays([pa.array([fi], pa.int32()), pa.array([total]), null(1, pa.int32()), null(1, pa.int64()), null(1, pa.int64()),
                                                  null(1, pa.int64()), null(1, pa.int32()), null(1, pa.int64()), null(1, pa.int32())], names=_ASK)
                for target, at, sign in ((in_high, high, 1), (in_low, low, -1)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, fi), pa.int32()), null(n, pa.float64()), pa.array(np.full(n, chunk), pa.int32()),
                                                      pa.array(ask), pa.array(w[ask]), pa.array(own[ask]), pa.array(target[ask], pa.int32()), pa.array(at[ask]),
                                                      pa.array(np.full(n, sign), pa.int32())], names=_ASK)
    return run


_ASK = ["fi", "total", "home", "at", "w", "own", "chunk", "t", "sign"]


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the chunk below each range end that asks it, signed."""
    for b in batches:
        for i in range(b.num_rows):
            q, w, asks = _ints(b.column("q")[i].as_py() or b""), _ints(b.column("w")[i].as_py() or b""), b.column("asks")[i].values
            below = np.concatenate([[0], np.cumsum(w)])[np.searchsorted(q, asks.field("t").to_numpy())] + b.column("offset")[i].as_py()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(asks), b.column("fi")[i].as_py()), pa.int32()), asks.field("home"), asks.field("at"),
                                              asks.field("w"), asks.field("own"), pa.array(below * asks.field("sign").to_numpy())],
                                             names=["fi", "home", "at", "w", "own", "part"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        w, own, m = (b.column(c).to_numpy() for c in ("w", "own", "m"))
        yield pa.RecordBatch.from_arrays([b.column("fi"), pa.array(w * (digamma(own) - digamma(m)))], names=["fi", "total"])


def neighbour_scores(df: DataFrame, label: str, col: str = "features", k: int = 3, chunk: int = CHUNK) -> DataFrame:
    """(fi, score) of each feature of the vectors ``col``. Rows without a label do not count; without two rows of one class, or for
    a constant feature, the score is 0. Missing values (null, NaN) are an error of the caller: impute them first."""
    from tessera.operators.select import _summary, _width

    spark, width = df.sparkSession, _width(df, col)
    df = df.where(F.col(label).isNotNull()).select(F.col(label).alias("y"), F.col(col).alias("x"))
    classes = df.groupBy("y").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    classes = written(ordered_rank(classes, ["y"], out="c").withColumn("k", F.least(F.lit(k), F.col("n") - 1)), "classes")
    psi = F.udf(lambda n: float(digamma(np.array([n]))[0]), "double")
    size = classes.agg(F.sum("n").alias("n"), F.sum(F.col("n") * psi("n")).alias("s")).first()
    every = spark.range(width).select(F.col("id").cast("int").alias("fi"))
    if not size["n"]:
        return every.select("fi", F.lit(0.0).alias("score"))
    spread = {r["fi"]: (r["variance"] * (r["n"] - 1) / r["n"]) ** 0.5 if r["n"] > 1 else 0.0 for r in _summary(df, "x", ["variance"]).collect()}
    live = {i: s for i, s in spread.items() if s > 0}
    if not live:
        return every.select("fi", F.lit(0.0).alias("score"))
    scale = F.array(*[F.lit(live[i] * GRID if i in live else None).cast("double") for i in sorted(spread)])
    long = df.join(classes, "y").select("c", "k", F.posexplode(F.zip_with("x", scale, lambda v, s: F.round(v / s).cast("long"))).alias("fi", "q")).where("q IS NOT NULL")
    folded = written(long.groupBy("fi", "q", "c").agg(F.first("k").alias("k"), F.count(F.lit(1)).alias("w")), "folded")
    # chunks: bounds by feature, of which no more than one in ``chunk`` distinct values comes to the driver
    most = folded.groupBy("fi").count().agg(F.max("count")).first()[0]
    cuts = -(-most // chunk)
    bounds = {i: np.zeros(0, np.int64) for i in spread}
    if cuts > 1:
        at = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
        bounds |= {r["fi"]: np.unique(r["b"]) for r in folded.groupBy("fi").agg(F.percentile_approx("q", at, 10 * cuts).alias("b")).collect()}
    shared = spark.sparkContext.broadcast(bounds)

    def to_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fi, q = b.column("fi").to_numpy(), b.column("q").to_numpy()
            out = np.zeros(len(fi), np.int32)
            for i in np.unique(fi).tolist():
                out[fi == i] = np.searchsorted(shared.value[i], q[fi == i], side="right")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], names=[*b.schema.names, "chunk"])

    placed = folded.select("fi", "q", "c", F.col("k").cast("long").alias("k"), "w").mapInArrow(to_chunks, "fi int, q long, c long, k long, w long, chunk int")
    packed = written(placed.select("fi", "chunk", "q", "c", "k", "w").repartition("fi", "chunk").sortWithinPartitions("fi", "chunk", "q", "c")
                     .mapInArrow(_pack, "fi int, chunk int, q binary, c binary, k binary, w binary, rows long"), "chunks")
    pair = "array<struct<v: bigint, n: bigint>>"
    edges = packed.mapInArrow(_edges, f"fi int, c long, chunk int, first {pair}, last {pair}")
    along = W.partitionBy("fi", "c").orderBy("chunk")
    left = F.concat(*[F.coalesce(F.lag("last", j).over(along), F.array().cast(pair)) for j in range(k, 0, -1)])
    right = F.concat(*[F.coalesce(F.lead("first", j).over(along), F.array().cast(pair)) for j in range(1, k + 1)])
    around = edges.withColumn("left", left).withColumn("right", right).groupBy("fi", "chunk").agg(F.collect_list(F.struct("c", "left", "right")).alias("around"))
    asks = written(packed.join(around, ["fi", "chunk"]).mapInArrow(lambda bs: _ranges(shared.value, k)(bs),
                                                                   "fi int, total double, home int, at long, w long, own long, chunk int, t long, sign int"), "ranges")
    offset = F.coalesce(F.sum("rows").over(W.partitionBy("fi").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset")
    blocks = packed.select("fi", "chunk", "q", "w").join(packed.select("fi", "chunk", offset), ["fi", "chunk"])
    out = asks.where("total IS NOT NULL").select("fi", "total")
    if cuts > 1:
        # an end below all of a feature's values may ask a chunk that holds none: nothing is below it
        open_ = asks.where("total IS NULL")
        many = open_.groupBy("fi", "chunk").agg(F.ceil(F.count(F.lit(1)) / BATCH).alias("s"))
        groups = (open_.join(many, ["fi", "chunk"]).withColumn("salt", F.pmod(F.xxhash64("home", "at", "sign"), F.col("s"))).groupBy("fi", "chunk", "salt")
                  .agg(F.collect_list(F.struct("home", "at", "w", "own", "t", "sign")).alias("asks")))
        parts = groups.join(blocks, ["fi", "chunk"], "left").select("fi", "asks", "q", "w", F.coalesce("offset", F.lit(0)).alias("offset")).mapInArrow(_answer, "fi int, home int, at long, w long, own long, part long")
        met = parts.groupBy("fi", "home", "at").agg(F.first("w").alias("w"), F.first("own").alias("own"), F.sum("part").alias("m"))
        out = out.unionByName(met.select("fi", "w", "own", "m").mapInArrow(_settle, "fi int, total double"))
    const = float(digamma(np.array([size["n"]]))[0]) - size["s"] / size["n"]
    sums = out.groupBy("fi").agg(F.sum("total").alias("total"))
    return every.join(sums, "fi", "left").select("fi", F.coalesce(F.greatest(F.lit(0.0), F.lit(const) + F.col("total") / F.lit(size["n"])), F.lit(0.0)).alias("score"))
