import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import score as sco
from tessera.operators import select as fsel


def test_variance_threshold(spark):
    df = spark.createDataFrame([([0.0, 1.0],), ([1.0, 1.0],)], "features array<double>")
    sel = fsel.fit_select(df, "variance_threshold", None, threshold=0.3)
    assert sel.scores[0] == 0.25 and sel.indices == []
    sel = fsel.fit_select(df, "variance_threshold", None, threshold=0.01)
    assert sel.indices == [0]


def test_correlation_guard_constant_column(spark):
    rows = [([float(i), 5.0, 2.0 * i + 1], i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "features array<double>, y int")
    idx, ry, drop = fsel.correlation_select(df, "y", threshold=0.9, target_threshold=0.05)
    assert drop == {2}          # x2 = 2·x0 + 1
    assert ry[1] is None and 1 not in idx


def test_anova_matches_formula(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(60, 2))
    y = rng.integers(0, 3, 60)
    X[:, 0] += y
    df = spark.createDataFrame([(x.tolist(), int(c)) for x, c in zip(X, y)], "features array<double>, y int")
    got = {r["fi"]: r["score"] for r in fsel.anova_scores(df, "y").collect()}
    for j in range(2):
        groups = [X[y == c, j] for c in range(3)]
        gm = X[:, j].mean()
        ssb = sum(len(g) * (g.mean() - gm) ** 2 for g in groups)
        ssw = sum(((g - g.mean()) ** 2).sum() for g in groups)
        assert math.isclose(got[j], (ssb / 2) / (ssw / (60 - 3)), rel_tol=1e-9)


def test_chi2_rejects_negative(spark):
    df = spark.createDataFrame([([-1.0], 0), ([1.0], 1)], "features array<double>, y int")
    try:
        fsel.fit_select(df, "chi2", "y", k=1)
        raise AssertionError("expected an error")
    except ValueError:
        pass


def test_topk_ties_prefer_later_and_nan_lowest():
    assert fsel._topk({0: 1.0, 1: 1.0, 2: float("nan"), 3: 0.5}, 1) == [1]
    assert fsel._topk({0: 2.0, 1: None, 2: 3.0}, 2, ascending_output=True) == [0, 2]


def test_softmax_argmax_and_nan(spark):
    df = spark.createDataFrame([([0.0, 0.0, 0.0],), ([1.0, float("nan"), 2.0],)], "logits array<double>")
    out = sco.softmax_argmax(df).collect()
    assert out[0]["prediction"] == 0 and all(math.isclose(p, 1 / 3) for p in out[0]["probability"])
    assert out[1]["prediction"] == 2 and math.isclose(sum(out[1]["probability"]), 1.0)


def test_mlp_scoring_matches_numpy(spark):
    net = sco.mlp_weights([3, 4, 2], salt=5)
    X = np.array([[0.1, -0.2, 0.3], [1.0, 2.0, -1.0], [0.0, 0.0, 0.0]])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "id long, features array<double>")
    got = {r["id"]: r["logits"] for r in sco.score_mlp(df, net).collect()}
    want = sco.mlp_forward(X, net)
    for i in range(3):
        assert np.allclose(got[i], want[i])


def test_highway_identity_gate():
    # gate bias → -inf keeps x unchanged through the layer
    net = {"proj": None, "layers": [([[1.0]], [0.0])], "gates": [([[0.0]], [-1e9])], "out": ([[2.0]], [0.0])}
    assert np.allclose(sco.highway_forward(np.array([[3.0]]), net), [[6.0]])


def test_lstm_last_step_shape():
    net = {"lstm": [(sco.rule_weights(8, 2, 1), sco.rule_weights(8, 2, 2), sco.rule_bias(8, 3), sco.rule_bias(8, 4))],
           "static": (sco.rule_weights(8, 1, 5), sco.rule_bias(8, 5)),
           "fc1": (sco.rule_weights(8, 10, 6), sco.rule_bias(8, 6)),
           "fc2": (sco.rule_weights(3, 8, 7), sco.rule_bias(3, 7))}
    out = sco.hybrid_forward(np.ones((4, 2)), np.ones(1), net)
    assert out.shape == (3,)


def test_wide_correlation_path_agrees(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(80, 6))
    X[:, 3] = 5.0
    X[:, 4] = X[:, 0] * 2 + 0.01 * rng.normal(size=80)
    y = (X[:, 1] > 0).astype(int)
    df = spark.createDataFrame([(x.tolist(), int(c)) for x, c in zip(X, y)], "features array<double>, y int")
    pair, by_y = fsel.correlation_table(df, 6, "y")
    for i in range(6):
        if i == 3:
            assert by_y[3] is None
            continue
        assert math.isclose(by_y[i], np.corrcoef(X[:, i], y)[0, 1], rel_tol=1e-9, abs_tol=1e-12)
        for j in range(i + 1, 6):
            if j != 3:
                assert math.isclose(pair[i, j], np.corrcoef(X[:, i], X[:, j])[0, 1], rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("p", [1, 2, 4, 5, 12])
def test_correlation_treats_null_labels_alike_at_every_width(spark, p):
    rng = np.random.default_rng(p)
    X = rng.normal(size=(40, p))
    y = X[:, 0] + rng.normal(size=40)
    df = spark.createDataFrame([(x.tolist(), float(v) if i % 4 else None) for i, (x, v) in enumerate(zip(X, y))], "features array<double>, y double")
    _, by_y = fsel.correlation_table(df, p, "y")
    has = np.arange(40) % 4 > 0
    assert all(math.isclose(by_y[i], np.corrcoef(X[has, i], y[has])[0, 1], rel_tol=1e-9) for i in range(p))
    assert fsel.correlation_table(df.where("false"), p, "y")[1] == {i: None for i in range(p)}


def test_mutual_information_survives_one_far_value(spark):
    rows = [([float(i % 10), float(i % 7)], int(i % 10 > 4)) for i in range(1000)]
    df = spark.createDataFrame(rows, "features array<double>, y int")
    far = spark.createDataFrame([*rows[:-1], ([1e9, 1.0], rows[-1][1])], "features array<double>, y int")
    score = lambda d: {r["fi"]: r["score"] for r in fsel.mutual_info_scores(d, "y").collect()}
    assert math.isclose(score(df)[0], math.log(2), rel_tol=1e-6) and score(far)[0] > 0.68 and score(far)[1] < 0.1


def test_lasso_cv_equals_fits_on_the_rows(spark):
    """Moments of the folds against the same search on the rows themselves."""
    rng = np.random.default_rng(11)
    X = rng.normal(size=(150, 4))
    y = 2 * X[:, 1] - X[:, 2] + rng.normal(size=150)
    df = spark.createDataFrame([(x.tolist(), float(v)) for x, v in zip(X, y)], "features array<double>, y double")
    fold = np.array([r[0] for r in df.select(F.pmod(F.xxhash64("features", "y"), F.lit(5))).collect()])
    rows = df.collect()
    X, y = np.array([r["features"] for r in rows]), np.array([r["y"] for r in rows])

    def fit(x, t, alpha, w):
        xc, tc = x - x.mean(0), t - t.mean()
        return fsel.lasso_descent(xc.T @ xc / len(x), xc.T @ tc / len(x), alpha, w, tol=1e-10)

    top = np.abs((X - X.mean(0)).T @ (y - y.mean()) / len(y)).max()
    grid = [top * 1e-3 ** (i / 99) for i in range(100)]
    error = np.zeros(100)
    for f in range(5):
        tr, te, w = fold != f, fold == f, None
        for i, alpha in enumerate(grid):
            w = fit(X[tr], y[tr], alpha, w)
            error[i] += (((X[te] - X[tr].mean(0)) @ w + y[tr].mean() - y[te]) ** 2).mean()
    want = fit(X, y, grid[int(error.argmin())], None)
    assert np.allclose(fsel.lasso_cv_coefficients(df, "y"), want, atol=1e-6)
    assert np.allclose(fsel.lasso_cv_coefficients(df.repartition(7), "y"), want, atol=1e-6)


def test_lstm_batch_equals_per_sample():
    net = {"lstm": [(sco.rule_weights(8, 2, 1), sco.rule_weights(8, 2, 2), sco.rule_bias(8, 3), sco.rule_bias(8, 4)),
                    (sco.rule_weights(8, 2, 5), sco.rule_weights(8, 2, 6), sco.rule_bias(8, 7), sco.rule_bias(8, 8))],
           "static": (sco.rule_weights(8, 1, 5), sco.rule_bias(8, 5)),
           "fc1": (sco.rule_weights(8, 10, 6), sco.rule_bias(8, 6)),
           "fc2": (sco.rule_weights(3, 8, 7), sco.rule_bias(3, 7))}
    rng = np.random.default_rng(0)
    seqs = [rng.normal(size=(L, 2)).tolist() for L in (3, 5, 3, 1)]
    statics = [[0.5], [-1.0], [2.0], [0.0]]
    got = sco.hybrid_forward_batch(seqs, statics, net)
    for i in range(4):
        assert np.allclose(got[i], sco.hybrid_forward(np.asarray(seqs[i]), np.asarray(statics[i]), net))


def test_pca_projection_matches_numpy(spark):
    rng = np.random.default_rng(8)
    X = rng.normal(size=(50, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "i long, features array<double>")
    sel = fsel.fit_select(df, "pca", None, k=2)
    got = np.array([r["features"] for r in fsel.apply_select(df, sel).orderBy("i").collect()])
    want = (X - np.array(sel.centre)) @ np.array(sel.projection).T
    assert np.allclose(got, want)
    # components are orthonormal and sign-fixed (largest |loading| positive)
    P = np.array(sel.projection)
    assert np.allclose(P @ P.T, np.eye(2), atol=1e-8)
    assert all(row[np.argmax(np.abs(row))] > 0 for row in P)
    # the first component is the top eigenvector of the covariance
    w, v = np.linalg.eigh(np.cov((X - X.mean(0)).T))
    assert abs(abs(np.dot(v[:, -1], P[0])) - 1) < 1e-6


def _lasso_cd(X, y, alpha, iters=5000):
    """min (1/2n)‖y − Xw − b‖² + α‖w‖₁ by coordinate descent (centred data)."""
    n, p = X.shape
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.zeros(p)
    for _ in range(iters):
        for j in range(p):
            r = yc - Xc @ w + Xc[:, j] * w[j]
            rho = Xc[:, j] @ r / n
            z = (Xc[:, j] ** 2).sum() / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0.0) / z
    return w


def test_lasso_matches_coordinate_descent(spark):
    rng = np.random.default_rng(12)
    X = rng.normal(size=(200, 5))
    y = 2.0 * X[:, 0] - 0.5 * X[:, 2] + 0.05 * X[:, 4] + 0.1 * rng.normal(size=200)
    df = spark.createDataFrame([(x.tolist(), float(t)) for x, t in zip(X, y)], "features array<double>, y double")
    got = np.array(fsel.lasso_coefficients(df, "y", alpha=0.1))
    want = _lasso_cd(X, y, 0.1)
    assert np.allclose(got, want, atol=1e-3), (got, want)
    sel = fsel.fit_select(df, "lasso", "y", alpha=0.1)
    assert sel.indices == [i for i in range(5) if abs(want[i]) > 1e-9]


def test_logistic_first_row_matches_numpy(spark):
    rng = np.random.default_rng(21)
    n, p, K = 240, 3, 3
    X = rng.normal(size=(n, p))
    y = np.argmax(X @ rng.normal(size=(p, K)) + 0.5 * rng.normal(size=(n, K)), axis=1)
    df = spark.createDataFrame([(x.tolist(), int(c)) for x, c in zip(X, y)], "features array<double>, y int")
    got = np.array(fsel.logistic_first_row(df, "y", C=1.0))
    # sklearn objective (C=1): Σ CE + ½‖W‖², i.e. mean CE + ‖W‖² / (2n); intercepts unpenalised
    W, b, Y = np.zeros((K, p)), np.zeros(K), np.eye(K)[y]
    for _ in range(20000):
        Z = X @ W.T + b
        P = np.exp(Z - Z.max(1, keepdims=True))
        P /= P.sum(1, keepdims=True)
        gW = (P - Y).T @ X / n + W / n
        gb = (P - Y).mean(0)
        W -= 0.5 * gW
        b -= 0.5 * gb
    assert np.allclose(got, np.abs(W[0]), atol=2e-3), (got, np.abs(W[0]))


def test_forest_importances_and_ascending_selection(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(300, 4))
    y = (X[:, 2] > 0).astype(int) + (X[:, 0] > 1).astype(int)
    df = spark.createDataFrame([(x.tolist(), int(c)) for x, c in zip(X, y)], "features array<double>, y int")
    sel = fsel.fit_select(df, "random_forest", "y", k=2)
    imp = np.array([sel.scores[i] for i in range(4)])
    assert abs(imp.sum() - 1) < 1e-9 and np.argmax(imp) == 2
    assert sel.indices == sorted(sel.indices, key=lambda i: imp[i]) and sel.indices[-1] == 2
    reg = fsel.fit_select(df, "rf_importance", "y", k=1)
    assert reg.indices == [2]


def test_fitted_learners_predict_known_classes(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(200, 3))
    y = (X[:, 0] + 0.1 * rng.normal(size=200) > 0).astype(int)
    df = spark.createDataFrame([(i, x.tolist(), int(c)) for i, (x, c) in enumerate(zip(X, y))],
                               "id long, features array<double>, y int")
    from pyspark.ml.functions import array_to_vector
    m = sco.fit_mlp(df, "y", hidden=(4,), max_iter=50)
    pred = m.transform(df.withColumn("_v", array_to_vector("features"))).select("prediction", "y").toPandas()
    assert set(pred["prediction"].astype(int)) <= {0, 1} and (pred["prediction"] == pred["y"]).mean() > 0.8
    from tessera.operators import balance as bal
    net = sco.fit_weighted_linear(bal.with_class_weights(df, "y"), "y", "weight")
    scored = sco.score_mlp(df, net, keep=["id", "y"]).toPandas()
    assert (scored["prediction"] == scored["y"]).mean() > 0.9


def test_lasso_cv_falls_back_to_top_n(spark):
    rng = np.random.default_rng(6)
    X = rng.normal(size=(120, 3))
    y = 3 * X[:, 1] + 0.1 * rng.normal(size=120)
    df = spark.createDataFrame([(x.tolist(), float(t)) for x, t in zip(X, y)], "features array<double>, y double")
    sel = fsel.fit_select(df, "lasso_cv", "y", k=2)
    assert 1 in sel.indices


def test_quantile_cuts_are_exact_by_a_small_sketch(spark, monkeypatch):
    """Edges are the values of rank ceil(n·k / bins) whatever the sketch's error; ties, few values, nulls, a bracket that misses."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=3000), rng.integers(0, 2, 3000), rng.integers(0, 40, 3000), np.full(3000, 7.0), rng.normal(size=3000)])
    rows = [([None if j == 4 and i % 3 == 0 else float(v) for j, v in enumerate(r)],) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "features array<double>").repartition(5)

    def want(bins):
        cols = [np.sort([r[0][j] for r in rows if r[0][j] is not None]) for j in range(5)]
        return [[c[-(-len(c) * k // bins) - 1] for k in range(1, bins)] for c in cols]

    asked = []
    real = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda c, at, accuracy: asked.append(accuracy) or real(c, at, accuracy))
    assert fsel.quantile_cuts(df, 5) == want(10) and max(asked) <= 10_000  # a sketch of 1,000,000 held every value
    assert fsel.quantile_cuts(df, 5, bins=3, accuracy=50) == want(3)
    monkeypatch.setattr(F, "percentile_approx", lambda c, at, accuracy: F.array(*[F.min(c)] * 18))
    assert fsel.quantile_cuts(df, 5) == want(10)
    monkeypatch.undo()
    assert fsel.quantile_cuts(df.where("false"), 2) == [[], []] and fsel.quantile_cuts(df, 0) == []
