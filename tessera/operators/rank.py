"""Exact ranks by a keyed hash without an unpartitioned window.

``row_number().over(Window.orderBy(h))`` or ``partitionBy(label)`` would sort
all rows (or a whole class) in one task. Here the hash's top bits pick one of
``buckets`` buckets; a small aggregate counts rows per (group, bucket); a
window over that count table gives each bucket its offset, which is joined
back; and only (group, bucket) — about n / buckets rows — is sorted per task.
A hot group is spread over all buckets like any other. Without a group the
offsets are as many rows as buckets and are broadcast; with one, adaptive
execution decides from their measured size, however many groups there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.functions.keys import keyed_hash60
from tessera.functions.ranges import chunk_column

def hash_rank(df: DataFrame, keys, seed=42, group=(), buckets: int = 4096, out: str = "_rank",
              with_total: bool = False) -> DataFrame:
    """Add ``out``: 1-based rank of each row within ``group`` when rows are
    ordered by md5(seed:keys) (ties, which need an md5 collision, by keys).
    ``with_total`` also adds ``_group_n`` (rows in the group)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    group = [group] if isinstance(group, str) else list(group)
    bits = max(1, (buckets - 1).bit_length())
    h = df.withColumn("_h", keyed_hash60(seed, *keys)) \
          .withColumn("_b", F.shiftright(F.col("_h"), 60 - bits))
    counts = h.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    wg = W.partitionBy(*group).orderBy("_b") if group else W.orderBy("_b")
    offs = counts.select(*group, "_b",
                         F.coalesce(F.sum("_bn").over(wg.rowsBetween(W.unboundedPreceding, -1)),
                                    F.lit(0)).alias("_off"),
                         F.sum("_bn").over(wg.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
                         .alias("_group_n"))
    offs = offs if group else F.broadcast(offs)
    j = h.join(offs, [*group, "_b"])
    wl = W.partitionBy(*group, "_b").orderBy("_h", *keys)
    r = j.withColumn(out, F.col("_off") + F.row_number().over(wl))
    drop = ["_h", "_b", "_off"] + ([] if with_total else ["_group_n"])
    return r.drop(*drop)


def ordered_rank(df: DataFrame, order, out: str = "_rank", chunks: int | None = None) -> DataFrame:
    """1-based global rank by ``order`` columns (unique), without a
    single-task window: bounds that are literals of the plan cut the rows into
    ordered chunks, the rows per chunk are counted, and the chunk offsets (one
    row per chunk, broadcast) are added to a local row number."""
    order = [order] if isinstance(order, str) else list(order)
    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn("_chunk", chunk_column(df, order, n))
    counts = ranged.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_cn"))
    offs = counts.select("_chunk", F.coalesce(F.sum("_cn").over(
        W.orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    j = ranged.join(F.broadcast(offs), "_chunk")
    return j.withColumn(out, F.col("_off") + F.row_number().over(
        W.partitionBy("_chunk").orderBy(*order))).drop("_chunk", "_off")


def hash_within(df: DataFrame, keys, limits, seed=42, group=(), buckets: int = 4096,
                out: str = "_in") -> DataFrame:
    """Add boolean ``out``: is the row's keyed-hash rank within its group
    ≤ the group's limit? Same answer as ``hash_rank(...) <= limit``, but
    without shuffling every row: bucket counts (a small aggregate) decide
    whole buckets map-side through a broadcast join, and only each group's
    one boundary bucket is shuffled and ranked.

    ``limits``: an int (every group) or a DataFrame (group…, ``_lim``) with
    one row per group (low cardinality, like a class table)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    group = [group] if isinstance(group, str) else list(group)
    bits = max(1, (buckets - 1).bit_length())
    h = df.withColumn("_h", keyed_hash60(seed, *keys)).withColumn("_b", F.shiftright(F.col("_h"), 60 - bits))
    counts = h.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    wg = W.partitionBy(*group).orderBy("_b") if group else W.orderBy("_b")
    offs = counts.select(*group, "_b", "_bn", F.coalesce(F.sum("_bn").over(
        wg.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    if isinstance(limits, int):
        offs = offs.withColumn("_lim", F.lit(limits).cast("bigint"))
    else:
        offs = offs.join(limits.select(*group, F.col("_lim").cast("bigint").alias("_lim")), group)
    offs = offs.withColumn("_state", F.when(F.col("_off") + F.col("_bn") <= F.col("_lim"), F.lit(1))
                           .when(F.col("_off") >= F.col("_lim"), F.lit(0)).otherwise(F.lit(2)))
    offs = offs if group else F.broadcast(offs)
    j = h.join(offs.select(*group, "_b", "_off", "_lim", "_state"), [*group, "_b"])
    sure = j.where(F.col("_state") != 2).withColumn(out, F.col("_state") == 1)
    edge = j.where(F.col("_state") == 2).withColumn(
        out, F.col("_off") + F.row_number().over(W.partitionBy(*group, "_b").orderBy("_h", *keys)) <= F.col("_lim"))
    return sure.unionByName(edge).drop("_h", "_b", "_off", "_lim", "_state")
