import math
import random

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import knn


def _nan_euclid(a, b):
    common = [i for i in range(len(a)) if a[i] is not None and b[i] is not None]
    if not common:
        return None
    return math.sqrt(len(a) / len(common) * sum((a[i] - b[i]) ** 2 for i in common))


def _brute_impute(rows, k=5):
    """Reference semantics on plain Python rows: (key, [x0, x1, x2])."""
    out = {}
    p = len(rows[0][1])
    for key, x in rows:
        y = list(x)
        for t in range(p):
            if x[t] is not None:
                continue
            cands = []
            for dk, d in rows:
                if d[t] is None:
                    continue
                dist = _nan_euclid([v if i != t else None for i, v in enumerate(x)],
                                   [v if i != t else None for i, v in enumerate(d)])
                if dist is not None:
                    cands.append((dist, dk, d[t]))
            cands.sort()
            if cands:
                y[t] = sum(v for _, _, v in cands[:k]) / len(cands[:k])
            else:
                vals = [d[t] for _, d in rows if d[t] is not None]
                y[t] = sum(vals) / len(vals)
        out[key] = y
    return out


def test_knn_impute_matches_brute_force_with_mixed_patterns(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(120):
        x = [round(rnd.uniform(0, 10), 2), round(rnd.uniform(-5, 5), 2), float(rnd.randint(0, 3))]
        for j in range(3):
            if rnd.random() < 0.2:
                x[j] = None
        rows.append((i, x))
    df = spark.createDataFrame([(i, *x) for i, x in rows], "key long, a double, b double, c double")
    got = {r["key"]: [r["a"], r["b"], r["c"]] for r in knn.knn_impute(df, "key", ["a", "b", "c"]).collect()}
    want = _brute_impute(rows)
    for key in want:
        assert np.allclose(got[key], want[key]), (key, got[key], want[key])


def test_exact_knn_matches_brute_force_in_5d(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(150, 5))
    X[:40] *= 0.01                                   # a dense clump
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(150)], "k long, vec array<double>")
    got = knn.exact_knn(df, df.withColumnRenamed("k", "d"), "k", "d", "vec", 4, exclude_self=True)
    res = {}
    for r in got.collect():
        res.setdefault(r["k"], []).append((r["nn_rank"], r["d"]))
    for i in range(150):
        d = np.sqrt(((X - X[i]) ** 2).sum(axis=1))
        order = sorted((d[j], j) for j in range(150) if j != i)[:4]
        assert [j for _, j in order] == [j for _, j in sorted(res[i])]


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(i < 12), rng.normal(size=3).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, y int, features array<double>")
    out = knn.smote(df, "y", "k", "features", k=5, seed=42)
    c = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert c == {0: 48, 1: 48}
    X = {k: np.array(v) for k, _, v in rows}
    for r in out.where("synthetic >= 0").collect():
        base = X[r["k"]]
        new = np.array(r["features"])
        # on a segment from the base row to one of the other minority rows
        ok = False
        for j, y, _ in rows:
            if y == 1 and j != r["k"]:
                d = X[j] - base
                u = np.dot(new - base, d) / np.dot(d, d)
                if -1e-9 <= u <= 1 + 1e-9 and np.allclose(base + u * d, new):
                    ok = True
                    break
        assert ok


def test_exact_knn_with_a_hot_duplicate_vector(spark):
    rng = np.random.default_rng(9)
    X = rng.normal(size=(200, 2))
    X[:90] = [0.25, -0.5]                            # 45 % of rows share one vector
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(200)], "k long, vec array<double>")
    got = knn.exact_knn(df, df.withColumnRenamed("k", "d"), "k", "d", "vec", 5, exclude_self=True)
    res = {}
    for r in got.collect():
        res.setdefault(r["k"], []).append((r["nn_rank"], r["d"]))
    for i in range(200):
        d = np.sqrt(((X - X[i]) ** 2).sum(axis=1))
        want = [j for _, j in sorted((d[j], j) for j in range(200) if j != i)[:5]]
        assert [j for _, j in sorted(res[i])] == want


def test_pipeline_knn_transform_uses_training_donors(spark):
    from tessera.plans import prep
    rows = [(i, None if i % 4 == 0 else float(i), float(i % 7), "a" if i % 2 else "b", i % 3) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, x double, z double, c string, y int")
    x, st, _ = prep.fit_transform(df, prep.PrepConfig(target="y", keys=("id",), imp="knn"))
    a = {r["id"]: r["features"] for r in x.collect()}
    b = {r["id"]: r["features"] for r in prep.transform(df.drop("y"), st).collect()}
    assert a == b
    # a new row with x missing: its 5 nearest training rows by z (ties → smaller key)
    new = spark.createDataFrame([(1000, None, 3.0, "a")], "id long, x double, z double, c string")
    f = prep.transform(new, st).first()["features"]
    donors = sorted((abs(3.0 - (i % 7)), i) for i in range(40) if i % 4 != 0)[:5]
    want = sum(float(i) for _, i in donors) / 5
    assert abs(f[0] * st.scale["x"] + st.mean["x"] - want) < 1e-9


def test_exact_knn_far_from_origin_and_empty(spark):
    rows = [(i, [1e12 + (i % 3) * 1e-6, 5.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "k long, vec array<double>")
    got = knn.exact_knn(df, df.withColumnRenamed("k", "d"), "k", "d", "vec", 3, exclude_self=True)
    assert got.count() == 90
    empty = df.where("k < 0")
    assert knn.exact_knn(df, empty.withColumnRenamed("k", "d"), "k", "d", "vec", 3).count() == 0


def test_knn_impute_with_more_patterns_than_could_be_listed(spark):
    """2 000 rows, 9 columns, a fifth missing, all-missing rows among them."""
    rng = np.random.default_rng(12)
    X = rng.normal(size=(400, 9))
    X[:, 3] *= 20
    X[rng.random(X.shape) < 0.2] = np.nan
    X[7] = np.nan
    cols = [f"c{i}" for i in range(9)]
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], ["k", *cols])
    got = {r["k"]: [r[c] for c in cols] for r in knn.knn_impute(df, "k", cols).collect()}
    assert len({tuple(np.isnan(x)) for x in X}) > 64
    mean = np.nanmean(X, 0)
    for i in range(400):
        common = ~np.isnan(X[i]) & ~np.isnan(X)
        d = np.sqrt(9 / np.maximum(common.sum(1), 1) * np.where(common, (X - X[i]) ** 2, 0).sum(1))
        for c in range(9):
            if np.isnan(X[i, c]):
                have = [j for j in range(400) if j != i and not np.isnan(X[j, c]) and common[j].any()]
                best = sorted(have, key=lambda j: (d[j], j))[:5]
                want = X[best, c].mean() if best else mean[c]
                assert abs(got[i][c] - want) < 1e-9, (i, c)


def _frame(spark, X):
    return spark.createDataFrame([(i, [None if math.isnan(v) else float(v) for v in x]) for i, x in enumerate(X)], "k long, vec array<double>")


def test_nan_neighbours_with_small_leaves_and_blocks(spark):
    """Trees with missing children, blocks smaller than leaves, rows without a coordinate in common, ties."""
    rng = np.random.default_rng(3)
    X = np.round(rng.normal(size=(300, 4)), 1)
    X[rng.random(X.shape) < 0.35] = np.nan
    X = X[~np.isnan(X).all(1)]
    df = _frame(spark, X)
    got = {}
    for r in knn.nan_knn(df, df.withColumnRenamed("k", "d"), "k", "d", 7, 4, "vec", 6, leaf=3, block=5, first=2).collect():
        got.setdefault(r["k"], []).append((r["nn_rank"], r["d"]))
    for i, x in enumerate(X):
        common = (~np.isnan(X) & ~np.isnan(x)).sum(1)
        dist = [(math.sqrt(7 / c * s), j) for j, (c, s) in enumerate(zip(common, np.nan_to_num((X - x) ** 2).sum(1))) if c]
        assert [d for _, d in sorted(got[i])] == [j for _, j in sorted(dist)[:6]], i


def test_neighbours_by_class_in_many_dimensions(spark):
    """64 coordinates go by their leading axes; classes of very different size, one of a single row."""
    rng = np.random.default_rng(4)
    X = rng.normal(size=(500, 5)) @ rng.normal(size=(5, 64)) + 0.01 * rng.normal(size=(500, 64)) + 100
    y = np.array([0] * 400 + [1] * 90 + [2] * 9 + [3])
    df = spark.createDataFrame([(f"r{i:03}", int(y[i]), X[i].tolist()) for i in range(500)], "k string, y int, vec array<double>")
    stats = {}
    got = {}
    for r in knn.exact_knn(df, df.withColumnRenamed("k", "d"), "k", "d", "vec", 5, part=["y"], exclude_self=True, stats=stats, leaf=8, block=30, first=20).collect():
        got.setdefault(r["k"], []).append((r["nn_rank"], r["d"]))
    for i in range(500):
        same = [j for j in range(500) if y[j] == y[i] and j != i]
        want = sorted((float(np.sqrt(((X[j] - X[i]) ** 2).sum())), f"r{j:03}") for j in same)[:5]
        assert [d for _, d in sorted(got.get(f"r{i:03}", []))] == [d for _, d in want]
    assert stats["candidates"] < 0.45 * sum(int((y == c).sum()) ** 2 for c in range(4))


def test_candidates_grow_little_faster_than_the_rows(spark):
    """Ten columns of three factors, a fifth missing: twice the rows, less than 1.3 times the candidates a row."""
    rng = np.random.default_rng(1)
    mix, seen = rng.normal(size=(3, 10)), []
    for n in (4000, 8000):
        X = rng.normal(size=(n, 3)) @ mix + 0.1 * rng.normal(size=(n, 10))
        X[rng.random(X.shape) < 0.2] = np.nan
        gone = np.isnan(X[:, 0])
        df, stats = _frame(spark, X[:, 1:]), {}
        rows = df.join(spark.createDataFrame([(i, bool(g)) for i, g in enumerate(gone)], "k long, gone boolean"), "k")
        q = rows.where("gone")
        assert knn.nan_knn(q, rows.where("NOT gone").withColumnRenamed("k", "d"), "k", "d", 10, 9, "vec", 5, stats=stats).count() == 5 * int(gone.sum())
        seen.append(stats["candidates"])
    assert seen[1] < 1.3 * 2 * seen[0]


def test_a_hot_cell_is_met_in_batches(spark):
    """Very many queries at one place: no task takes them all at once."""
    df = spark.range(3000).select(F.col("id").alias("k"), F.array(F.lit(0.5), (F.col("id") % 7).cast("double") * 1e-3).alias("vec"))
    donors = spark.range(40).select(F.col("id").alias("d"), F.array((F.col("id") / 40), F.lit(0.0)).alias("vec"))
    out = knn.exact_knn(df, donors, "k", "d", "vec", 2)
    assert out.groupBy("d").count().count() <= 3 and out.count() == 6000


def test_sample_of_the_index_has_bounded_rows(spark, monkeypatch):
    """One coordinate leaves room for two million rows in ``SAMPLE``: rows, leaves and boxes in the driver stay below ``ROWS``."""
    from tessera.operators import neighbours as nb
    monkeypatch.setattr(nb, "ROWS", 1500)
    grown, real = [], nb.Tree.grow
    monkeypatch.setattr(nb.Tree, "grow", staticmethod(lambda z, leaf, cell: grown.append(len(z)) or real(z, leaf, cell)))
    d = spark.range(20_000).select(F.col("id").alias("dk"), F.array(((F.col("id") * 7919) % 20_011).cast("double")).alias("vec"))
    q = d.where("dk % 40 = 0").select(F.col("dk").alias("qk"), F.transform("vec", lambda v: v + 0.25).alias("vec"))
    got = {(r.qk, r.nn_rank): r.dist for r in knn.nan_knn(q, d, "qk", "dk", 2, 1, k=3).collect()}
    assert grown and max(grown) < 2000
    values = np.sort(np.arange(20_000) * 7919 % 20_011)
    for r in q.collect():
        want = np.sort(np.abs(values - r.vec[0]))[:3] * 2 ** 0.5
        assert np.allclose([got[(r.qk, i)] for i in (1, 2, 3)], want)
