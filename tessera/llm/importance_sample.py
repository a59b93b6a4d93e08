"""Resampling towards a target distribution: array-scored weights and a distributed radix sort.

Words and pairs of words are hashed into a fixed number of buckets. The counts
of the raw and the target texts make one array of gains, by which each text is
scored in the pass that reads it. Scores with Gumbel noise of a keyed hash are
ranked by a least-significant-digit radix sort: each pass counts the digits of
every part, prefix sums over (digit, part) give each row its destination, and
rows of one digit keep their order. After the last digit the destination is
the rank.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import free_name, materialize, slices, utf8

#: Bits of a digit, and rows of a part, of the radix sort.
DIGIT, PART = 16, 1 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_POLY = 0xEDB88320
#: What a worker remembers of words: their crc32; past so many it forgets, which costs time only.
REMEMBERED = 500_000


@cache
def _shift_tables(n: int) -> np.ndarray:
    """Four tables of 256: crc32 of a text followed by ``n`` zero bytes is their values xored, by the bytes of its crc32."""
    def zero(c: np.ndarray) -> np.ndarray:
        for _ in range(8):
            c = np.where(c & 1, (c >> 1) ^ _POLY, c >> 1)
        return c

    out = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)])
    for _ in range(n):
        out = zero(out).astype(np.uint32)
    return out


def joined_crc(left: np.ndarray, right: np.ndarray, n: np.ndarray) -> np.ndarray:
    """crc32 of each left text followed by its right one, from their crc32s and the lengths of the right ones."""
    out = right.copy()
    for size in np.unique(n).tolist():
        at = np.nonzero(n == size)[0]
        tables, c = _shift_tables(size), left[at]
        for i in range(4):
            out[at] ^= tables[i][(c >> np.uint32(8 * i)) & np.uint32(255)]
    return out


class Features:
    """Buckets of runs of one and two words; a worker remembers the crc32 of words."""

    def __init__(self, buckets: int):
        self.buckets, self.code = buckets, {}
        self.crc, self.spaced, self.size = [], [], []

    def of(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Each feature's bucket, texts one after the other (its words, then its pairs), and words of each text."""
        if len(self.code) > REMEMBERED:
            self.__init__(self.buckets)
        cut = [t.translate(_LOWER).split() if t else [] for t in texts]
        every = [w for ws in cut for w in ws]
        for w in set(every).difference(self.code):
            self.code[w] = len(self.crc)
            self.crc.append(zlib.crc32(w))
            self.spaced.append(zlib.crc32(b" ", zlib.crc32(w)))
            self.size.append(len(w))
        at = np.fromiter(map(self.code.__getitem__, every), np.int64, len(every))
        crc, spaced, size = (np.array(x, t)[at] for x, t in ((self.crc, np.uint32), (self.spaced, np.uint32), (self.size, np.int64)))
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        doc = np.repeat(np.arange(len(n)), n)
        pair = np.nonzero(doc[1:] == doc[:-1])[0]
        long = size[pair + 1] > 4096  # no table for each odd length
        pairs = np.zeros(len(pair), np.uint32)
        pairs[~long] = joined_crc(spaced[pair[~long]], crc[pair[~long] + 1], size[pair[~long] + 1])
        pairs[long] = [zlib.crc32(every[i + 1], int(spaced[i])) for i in pair[long].tolist()]
        return np.concatenate([crc, pairs]).astype(np.int64) % self.buckets, np.concatenate([doc, doc[pair]]), n


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = 10_000) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends its counts, ``buckets`` rows; ``buckets`` rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets), np.zeros(buckets, np.int64)
        for whole in batches:
            for b in slices(whole, "text"):
                total += np.bincount(features.of(utf8(b.column("text")))[0], minlength=buckets)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    rows = df.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(p/q)) of each bucket, one more feature counted in every bucket."""
    s, t, n = int(raw.sum()), int(target.sum()), len(raw)
    return np.array([math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(raw.tolist(), target.tolist())], np.int64)


def noise(key: str, seed: int) -> int:
    """floor(1000 g) with g of the standard Gumbel distribution, by a hash of seed and key."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", out: str = "weighed", seed: int = 7,
          keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) and a struct ``out``: n_words, n_features, weight (floored mean of the features' gains, 0 without any) and score.

    Null and empty texts have no words. A null id has the noise of the empty string.
    """
    buckets, shared = len(gain), df.sparkSession.sparkContext.broadcast(gain)
    fields = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight", "score")])
    names = [c for c in (df.columns if keep is None else keep) if c != out]
    schema = T.StructType([T.StructField("row", T.StructType([df.schema[c] for c in names])), T.StructField("made", fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, value = Features(buckets), shared.value
        for whole in batches:
            for b in slices(whole, "text"):
                bucket, doc, n = features.of(utf8(b.column("text")))
                total = np.zeros(len(n), np.int64)
                np.add.at(total, doc, value[bucket])
                m = np.maximum(2 * n - 1, 0)
                weight = total // np.maximum(m, 1)
                drawn = np.array([noise(k or "", seed) for k in b.column("key").to_pylist()], np.int64)
                made = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (n, m, weight, weight + drawn)], names=fields.names)
                yield pa.RecordBatch.from_arrays([b.column("row"), made], names=["row", "made"])

    rows = df.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{id_col}`").cast("string").alias("key"),
                     F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    return rows.mapInArrow(run, schema).select("row.*", F.col("made").alias(out))


def radix_rank(df: DataFrame, keys: list[Column], out: str = "rank", digit: int = DIGIT, part: int = PART) -> DataFrame:
    """``df`` and its rows' ranks (from 1) by the composite of integer ``keys``, first key first, least value first.

    A digit has ``digit`` bits; the sort passes over as many digits as the keys' ranges have, the last key's lowest
    first. A part holds ``part`` rows, whatever their keys, so that no value makes a part larger. Rows equal in all
    keys keep the order of the first pass (by the other columns' hash). Null keys are an error of the caller. Extra columns
    pass through (a column named ``out`` is replaced); an empty frame gives an empty result.
    """
    if out in df.columns:
        df = df.drop(out)
    key = [free_name(df, f"_key{i}") for i in range(len(keys))]
    at, digit_col, part_col, n, base, inside = (free_name(df, f"_{c}") for c in ("at", "digit", "part", "n", "base", "inside"))
    rows = materialize(df.select("*", *[k.cast("long").alias(c) for k, c in zip(keys, key)]), "radix")
    bounds = rows.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(key) for f in (F.min, F.max)]).first()
    if bounds["n"] == 0:
        return df.withColumn(out, F.lit(1).cast("long"))
    n_parts = -(-bounds["n"] // part)
    passes = []
    for i, c in reversed(list(enumerate(key))):
        lo, hi = bounds[f"min{i}"], bounds[f"max{i}"]
        narrow = hi - lo < 2**63  # else the values themselves, their sign bit turned, as unsigned numbers
        number = F.col(c) - F.lit(lo) if narrow else F.col(c).bitwiseXOR(F.lit(-2**63))
        passes += [F.shiftrightunsigned(number, shift) for shift in range(0, max(1, (hi - lo).bit_length()) if narrow else 64, digit)]
    # before the first pass any order will do that does not depend on how rows were read
    own = F.xxhash64(*[f"`{c}`" for c in df.columns])
    rows = rows.withColumn(part_col, F.pmod(own, F.lit(n_parts)).cast("int")).withColumn(at, own)
    for shifted in passes:
        # one exchange a pass: the rows of a part and digit come together, in their order; a hot digit is split by parts
        local = rows.withColumn(digit_col, shifted.bitwiseAND(F.lit((1 << digit) - 1)).cast("int"))
        local = local.withColumn(inside, F.row_number().over(Window.partitionBy(part_col, digit_col).orderBy(at, *key)) - 1)
        local = materialize(local, "radix")
        counts = materialize(local.groupBy(digit_col, part_col).agg(F.count(F.lit(1)).alias(n)), "digits")
        # global prefix: digits before, over 2 ** digit rows, then parts before within the digit
        totals = counts.groupBy(digit_col).agg(F.sum(n).alias("_total"))
        before = F.coalesce(F.sum("_total").over(Window.orderBy(digit_col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = totals.select(F.col(digit_col), before.alias("_before"))
        earlier = F.coalesce(F.sum(n).over(Window.partitionBy(digit_col).orderBy(part_col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        offsets = counts.withColumn("_earlier", earlier).join(F.broadcast(starts), digit_col)
        offsets = offsets.select(digit_col, part_col, (F.col("_before") + F.col("_earlier")).alias(base))
        rows = local.join(offsets, [digit_col, part_col]).withColumn(at, F.col(base) + F.col(inside))
        rows = rows.withColumn(part_col, F.floor(F.col(at) / F.lit(part)).cast("int")).drop(digit_col, inside, base)
    return rows.select(*[f"`{c}`" for c in df.columns], (F.col(at) + 1).cast("long").alias(out))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             percent: int = 25, least_words: int = 20, buckets: int = 10_000, seed: int = 7, out: str = "sample",
             keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) and a struct ``out``: n_features, weight, score, rank; rank is null for documents that are not drawn.

    Of the N documents with ``least_words`` words, floor(percent * N / 100) are drawn, those of highest score, ties to the smaller
    id (null ids first). Repeated rows are ranked one after the other. Null and empty texts have no features, weight 0. An empty
    target gives each bucket the same target share. An empty table gives an empty result. A column named ``out`` is replaced.
    """
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets))
    weighed = free_name(docs, "_weighed")
    narrow = free_name(docs, "_row")
    number = F.monotonically_increasing_id()
    rows = materialize(weigh(docs, gain, id_col, text_col, weighed, seed, list({id_col: 0, **dict.fromkeys(keep)}) if keep is not None else None)
                       .withColumn(narrow, number), "weighed")  # numbers stay, once written
    able = rows.where(F.col(f"{weighed}.n_words") >= least_words)
    drawn = able.count() * percent // 100
    keys = able.select(F.col(narrow).alias("row"), F.col(f"{weighed}.score").alias("score"),
                       F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-2**62)).alias("id"))
    ranks = radix_rank(keys, [-F.col("score"), F.col("id")]).where(F.col("rank") <= drawn).select(F.col("row").alias("_drawn"), "rank")
    both = rows.join(ranks, F.col(narrow) == F.col("_drawn"), "left")
    names = [c for c in (docs.columns if keep is None else keep) if c != out]
    return both.select(*[rows[f"`{c}`"] for c in names],
                       F.struct(*[F.col(f"{weighed}.{c}").alias(c) for c in ("n_features", "weight", "score")], F.col("rank")).alias(out))
