import math

import numpy as np
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.keys import keyed_md5
from tessera.operators import balance as bal
from tessera.operators import metrics as met
from tessera.operators.rank import hash_rank, ordered_rank


def _lab(spark, n=200, frac1=0.2):
    rows = [(i, 1 if i < n * frac1 else 0) for i in range(n)]
    return spark.createDataFrame(rows, "k long, y int")


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    w = {r["y"]: r["weight"] for r in bal.class_weights(df, "y").collect()}
    assert math.isclose(w[0], 4 / 6) and math.isclose(w[1], 2.0)


def test_hash_rank_equals_plain_sort(spark):
    df = _lab(spark, 500)
    got = hash_rank(df, "k", 42, group=["y"], buckets=16)
    want = df.withColumn("h", keyed_md5(42, "k")).withColumn(
        "r", F.row_number().over(W.partitionBy("y").orderBy("h", "k")))
    a = {(r["k"], r["_rank"]) for r in got.collect()}
    b = {(r["k"], r["r"]) for r in want.collect()}
    assert a == b


def test_ordered_rank(spark):
    df = spark.range(0, 300).withColumnRenamed("id", "k").repartition(5)
    got = sorted((r["k"], r["_rank"]) for r in ordered_rank(df, "k", chunks=4).collect())
    assert got == [(i, i + 1) for i in range(300)]


def test_under_sampling_balances(spark):
    out = bal.random_under(_lab(spark), "y", "k", 42)
    c = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert c == {0: 40, 1: 40}


def test_over_sampling_balances_and_keeps_originals(spark):
    out = bal.random_over(_lab(spark), "y", "k", 42)
    c = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert c == {0: 160, 1: 160}
    assert out.where("copy = 0").count() == 200
    assert out.where("copy > 0 AND y = 0").count() == 0


def test_stratified_split_exact_disjoint_complete(spark):
    df = _lab(spark, 203, 0.3)
    s = bal.stratified_split(df, "y", "k", 0.2, 42)
    assert s.count() == 203 and s.select("k").distinct().count() == 203
    c = {(r["split"], r["y"]): r["count"] for r in s.groupBy("split", "y").count().collect()}
    assert c[("val", 0)] + c[("val", 1)] == math.ceil(0.2 * 203)
    tc = {r["y"]: r["_lim"] for r in bal.split_counts(df, "y", 0.2).collect()}
    assert c[("val", 0)] == tc[0] and c[("val", 1)] == tc[1]


def test_split_counts_equal_largest_remainders_at_many_classes(spark):
    rng = np.random.default_rng(8)
    y = rng.integers(0, 700, 5000)
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "k long, y int")
    got = {r["y"]: r["_lim"] for r in bal.split_counts(df, "y", 0.3).collect()}
    counts = {int(c): int(n) for c, n in zip(*np.unique(y, return_counts=True))}
    n, n_train = 5000, 5000 - 1500
    base = {c: n_train * k // n for c, k in counts.items()}
    for c in sorted(counts, key=lambda c: (-(n_train * counts[c] % n), c))[:n_train - sum(base.values())]:
        base[c] += 1
    assert got == {c: counts[c] - base[c] for c in counts} and sum(got.values()) == 1500


def test_random_split_floor(spark):
    s = bal.random_split(spark.range(0, 101).withColumnRenamed("id", "k"), "k", 0.8)
    assert s.where("split = 'train'").count() == 80


def test_scores_against_numpy(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 4, 300)
    yh = np.where(rng.random(300) < 0.6, y, rng.integers(0, 4, 300))
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(y, yh)], "y int, yhat int")
    r = met.scores(met.confusion(df)).first()
    classes = sorted(set(y) | set(yh))
    sup = np.array([(y == c).sum() for c in classes])
    tp = np.array([((y == c) & (yh == c)).sum() for c in classes])
    pr = np.array([(yh == c).sum() for c in classes])
    p = np.where(pr > 0, tp / np.maximum(pr, 1), 0)
    rc = np.where(sup > 0, tp / np.maximum(sup, 1), 0)
    f1 = np.where(p + rc > 0, 2 * p * rc / np.maximum(p + rc, 1e-300), 0)
    assert math.isclose(r["accuracy"], (y == yh).mean())
    assert math.isclose(r["precision"], (sup * p).sum() / sup.sum())
    assert math.isclose(r["recall"], (sup * rc).sum() / sup.sum())
    assert math.isclose(r["f1"], (sup * f1).sum() / sup.sum())
    assert math.isclose(r["balanced_accuracy"], rc[sup > 0].mean())


def test_cross_entropy_weighted_and_batch_mean(spark):
    rows = [([0.0, 1.0], 1, 1.0, 0), ([2.0, 0.0], 0, 3.0, 0), ([0.0, 0.0], 1, 1.0, 1)]
    df = spark.createDataFrame(rows, "logits array<double>, y int, w double, b int")
    l = [-math.log(math.exp(1) / (1 + math.exp(1))), -math.log(math.exp(2) / (math.exp(2) + 1)), math.log(2)]
    assert math.isclose(met.cross_entropy(df).first()["loss"], sum(l) / 3)
    assert math.isclose(met.cross_entropy(df, weight="w").first()["loss"], (l[0] + 3 * l[1] + l[2]) / 5)
    assert math.isclose(met.cross_entropy(df, batch="b").first()["loss"], ((l[0] + l[1]) / 2 + l[2]) / 2)


def test_log_prob_codegen_path_equals_lambda_path(spark):
    rows = [([0.5, float("nan"), 2.0], 1), ([1.0, 1.0, 1.0], 2), ([-3.0, 0.0, 3.0], 0)]
    df = spark.createDataFrame(rows, "logits array<double>, y int")
    a = [r[0] for r in df.select(met.log_prob(F.col("logits"), F.col("y"))).collect()]
    b = [r[0] for r in df.select(met.log_prob(F.col("logits"), F.col("y"), n_classes=3)).collect()]
    assert all(math.isclose(x, z) for x, z in zip(a, b))


def test_hash_within_equals_rank_threshold(spark):
    from tessera.operators.rank import hash_within
    df = _lab(spark, 700, 0.3)
    lim = spark.createDataFrame([(0, 123), (1, 7)], "y int, _lim long")
    a = {r["k"]: r["_in"] for r in hash_within(df, "k", lim, 42, group=["y"], buckets=32).collect()}
    ranked = hash_rank(df, "k", 42, group=["y"], buckets=32).collect()
    b = {r["k"]: r["_rank"] <= (123 if r["y"] == 0 else 7) for r in ranked}
    assert a == b and sum(a.values()) == 130
