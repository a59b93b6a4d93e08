"""Class balance, splits and sampling.

Every draw is keyed (md5 of seed and key), so the chosen rows do not depend
on partitioning and a recomputed task draws the same rows. Per-class ranks
come from ``rank.hash_rank`` (bucketed, no class-wide sort in one task).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import keyed_index
from tessera.operators.rank import hash_rank, hash_within, ordered_rank
from tessera.session import written

def class_table(df: DataFrame, label: str) -> DataFrame:
    """Per-class counts (small: one row per class)."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """G1: balanced weights n / (classes · n_c), one row per class."""
    ct = written(class_table(df, label), "classes")
    total = ct.agg(F.coalesce(F.sum("n_c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("k")).first()   # one row
    return ct.select(label, "n_c", (F.lit(total["n"]) / (F.lit(total["k"]) * F.col("n_c"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Attach ``weight`` to every row: a join with the class table (one row
    per class; adaptive execution broadcasts it after measuring it)."""
    return df.join(class_weights(df, label).select(label, "weight"), label, "left")


def random_under(df: DataFrame, label: str, key, seed=42) -> DataFrame:
    """Every class cut to the minority count, without replacement (the
    n_min rows of each class with the smallest keyed hash)."""
    n_min = class_table(df, label).agg(F.min("n_c")).first()[0] or 0
    r = hash_within(df.where(F.col(label).isNotNull()), key, n_min, seed, group=[label])
    return r.where(F.col("_in")).drop("_in")


def deficits(df: DataFrame, label: str) -> DataFrame:
    """(label, n_c, d): the classes below the majority count and what they lack."""
    ct = written(class_table(df, label), "classes")
    n_max = ct.agg(F.max("n_c")).first()[0] or 0
    return ct.withColumn("d", F.lit(n_max) - F.col("n_c")).where("d > 0")


def draws(need: DataFrame, label: str, chunk: int = 1_000_000) -> DataFrame:
    """One row (label, n_c, i) for i in [0, d) per class of ``need``, made in
    chunks of ``chunk`` rows so a large deficit is spread over tasks."""
    chunks = need.select(label, "n_c", "d", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("d") - 1) / F.lit(chunk)))).alias("ch")).repartition(label, "ch")
    return chunks.select(label, "n_c", F.explode(F.sequence(
        F.col("ch") * chunk, F.least((F.col("ch") + 1) * chunk, F.col("d")) - 1)).alias("i"))


def random_over(df: DataFrame, label: str, key, seed=42) -> DataFrame:
    """Every class drawn up to the majority count with replacement;
    originals kept (``copy`` = 0), draw i of class c picks the row of rank
    md5(seed:c:i) mod n_c (``copy`` = i + 1). Only the classes that get draws
    are ranked."""
    keys = [key] if isinstance(key, str) else list(key)
    df = df.where(F.col(label).isNotNull())
    need = deficits(df, label)
    drawn = draws(need, label).select(
        label, "i", (keyed_index(seed, F.col("n_c"), F.col(label), F.col("i")) + 1).alias("_rank"))
    ranked = hash_rank(df.join(need.select(label), label, "left_semi"), keys, seed, group=[label])
    dup = ranked.join(drawn, [label, "_rank"]).withColumn("copy", F.col("i") + 1).drop("i", "_rank")
    return df.withColumn("copy", F.lit(0).cast("bigint")).unionByName(dup.select(*df.columns, "copy"))


def split_counts(df: DataFrame, label: str, test_size: float) -> DataFrame:
    """(label, n_c, _lim): rows of each class that a stratified split puts to the test side.

    n_test = ceil(test_size · n); the train share of each class is
    floor(n_train · n_c / n) plus one for the classes with the largest
    remainders (ties → smaller class); test takes the rest of the class. All
    by class table; two single rows come to the driver.
    """
    ct = written(class_table(df, label), "classes")
    n = ct.agg(F.sum("n_c")).first()[0] or 0
    if not n:
        return ct.withColumn("_lim", F.col("n_c"))
    n_train = n - math.ceil(test_size * n)
    product = F.lit(n_train).cast("decimal(19,0)") * F.col("n_c").cast("decimal(18,0)")
    t = ct.withColumn("_p", product).withColumn("_base", F.expr(f"CAST(_p div {n} AS BIGINT)")) \
          .withColumn("_minus", -(F.col("_p") % F.lit(n)).cast("decimal(38,0)"))
    extra = n_train - t.agg(F.sum("_base")).first()[0]
    t = ordered_rank(t.drop("_p"), ["_minus", label])
    return t.select(label, "n_c", (F.col("n_c") - F.col("_base") - F.when(F.col("_rank") <= extra, 1).otherwise(0)).alias("_lim"))


def stratified_split(df: DataFrame, label: str, key, test_size: float = 0.2, seed=42) -> DataFrame:
    """Exact stratified split; adds ``split`` = 'train' | 'val'. In each
    class the rows with the smallest keyed hash go to 'val'."""
    df = df.where(F.col(label).isNotNull())
    r = hash_within(df, key, split_counts(df, label, test_size), seed, group=[label])
    return r.withColumn("split", F.when(F.col("_in"), "val").otherwise("train")).drop("_in")


def take_split(df: DataFrame, split: str) -> DataFrame | tuple:
    """G7: 'train' | 'val' | 'both' (a (train, val) pair); anything else errors."""
    if split == "both":
        return df.where(F.col("split") == "train"), df.where(F.col("split") == "val")
    if split not in ("train", "val"):
        raise ValueError("split must be 'train', 'val' or 'both'")
    return df.where(F.col("split") == split)


def random_split(df: DataFrame, key, frac: float = 0.8, seed=42) -> DataFrame:
    """Unstratified split, train = floor(frac · n) rows with the
    smallest keyed hash; adds ``split``."""
    n = df.count()
    r = hash_within(df, key, int(math.floor(n * frac)), seed)
    return r.withColumn("split", F.when(F.col("_in"), "train").otherwise("val")).drop("_in")
