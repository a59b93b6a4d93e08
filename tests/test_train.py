import numpy as np

from tessera.operators import balance, score
from tessera.operators import train as tr


def frame(spark, x, y, w=None):
    rows = [(i, list(map(float, a)), None if b is None else int(b), float(w[i]) if w is not None else 1.0) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, features array<double>, y int, w double").repartition(3)


def data(n=150, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    return x, (x[:, 0] * x[:, 1] > 0).astype(int) + (x[:, 2] > 1), rng.uniform(.5, 3, n)


def test_gradient_by_differences(spark):
    x, y, w = data(40)
    sizes = [4, 5, 3, 3]
    theta = tr.initial(sizes, 1) + .05
    loss, gradient = tr.batch_loss(theta, sizes, x, y, w)
    for i in range(0, len(theta), 3):
        step = np.zeros(len(theta))
        step[i] = 1e-6
        slope = (tr.batch_loss(theta + step, sizes, x, y, w)[0] - tr.batch_loss(theta - step, sizes, x, y, w)[0]) / 2e-6
        assert abs(slope - gradient[i]) < 1e-4 * max(1, abs(slope))
    rows = frame(spark, x, y, w).selectExpr("features AS x", "y AS c", "w")
    total, full = tr.full_loss(rows, sizes, theta)
    assert abs(total - loss) < 1e-9 and np.allclose(full, gradient)


def test_loss_falls_to_the_optimum_of_a_numpy_run(spark):
    """The same steps on one array: ReLU units, weights, decay."""
    x, y, w = data()
    sizes = [4, 6, 3]
    decay = np.concatenate([np.ones(24), np.zeros(6), np.ones(18), np.zeros(3)]) * .01

    def fun(theta):
        loss, g = tr.batch_loss(theta, sizes, x, y, w)
        return loss / w.sum() + .5 * (decay * theta ** 2).sum(), g / w.sum() + decay * theta
    theta, want, _, done = tr.lbfgs(fun, tr.initial(sizes, 42), 1e-5, None)
    fit = tr.fit_network(frame(spark, x, y, w), "y", hidden=(6,), weight="w", l2=.01, tol=1e-5)
    assert done and fit.converged and fit.classes == [0, 1, 2]
    assert abs(fit.loss - want) < .01 * want and fit.loss < .8 * fun(np.zeros(len(theta)))[0]


def test_linear_with_class_weights_is_optimal(spark):
    x, y, _ = data()
    df = balance.with_class_weights(frame(spark, x, y).drop("w"), "y")
    fit = tr.fit_network(df, "y", hidden=(), weight="weight", l2=.05, tol=1e-9)
    weights = {r["y"]: r["weight"] for r in df.select("y", "weight").distinct().collect()}
    w = np.array([weights[c] for c in y])
    theta = np.concatenate([np.array(fit.layers[0][0]).ravel(), fit.layers[0][1]])
    _, g = tr.batch_loss(theta, [4, 3], x, y, w)
    assert np.abs(g / w.sum() + np.concatenate([np.ones(12), np.zeros(3)]) * .05 * theta).max() < 1e-4


def test_scores_and_odd_frames(spark):
    x, y, _ = data(60)
    labels = [None if i % 7 == 0 else int(v) * 10 for i, v in enumerate(y)]
    df = frame(spark, x, labels)
    fit = tr.fit_network(df, "y", hidden=(12,), tol=1e-5)
    got = {r["id"]: fit.classes[r["prediction"]] for r in score.score_mlp(df, fit.layers, keep=["id"]).collect()}
    right = [got[i] == v for i, v in enumerate(labels) if v is not None]
    assert fit.classes == [0, 10, 20] and np.mean(right) > .9
    assert tr.fit_network(df.where("y IS NULL"), "y").layers == []
    assert not tr.fit_network(df, "y", tol=0.0, max_steps=2).converged
