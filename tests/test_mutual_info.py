import math
import random

import numpy as np

from tessera.operators import mutual_info as mi
from tessera.operators import select as fsel


def psi(n):
    return -0.5772156649015329 + math.fsum(1 / i for i in range(1, n))


def brute(X, y, k=3):
    """The estimator by loops over all pairs."""
    X = np.asarray(X, float)
    y = np.asarray(y)
    out = []
    sd = X.std(0)
    keep = np.array([(y == c).sum() > 1 for c in y])
    for f in range(X.shape[1]):
        if sd[f] == 0 or not keep.any():
            out.append(0.0)
            continue
        q = np.round(X[keep, f] / (sd[f] * mi.GRID)).astype(np.int64)
        c, total = y[keep], 0.0
        for i in range(len(q)):
            same = np.sort(np.abs(q[c == c[i]] - q[i]))  # the first is the row itself
            kc = min(k, len(same) - 1)
            r = int(same[kc])
            m, own = ((np.abs(q - q[i]) < r).sum(), kc) if r else ((q == q[i]).sum(), (same == 0).sum())
            total += psi(int(own)) - psi(len(same)) - psi(int(m))
        out.append(max(0.0, psi(len(q)) + total / len(q)))
    return out


def frame(spark, X, y):
    return spark.createDataFrame([(list(map(float, x)), None if c is None else int(c)) for x, c in zip(X, y)], "features array<double>, y int").repartition(3)


def scores(df, **kw):
    return [s for _, s in sorted((r.fi, r.score) for r in mi.neighbour_scores(df, "y", **kw).collect())]


def data(n=260):
    rng = np.random.default_rng(7)
    y = rng.choice([0, 0, 0, 1, 2], n)
    X = np.column_stack([rng.normal(size=n), rng.normal(size=n) + y, np.where(y == 1, 1.0, 0.0), rng.integers(0, 4, n), np.full(n, 3.0),
                         np.where(rng.random(n) < .4, 0.0, rng.exponential(size=n) * (1 + y)), 1e6 + rng.normal(size=n) * (y + .1)])
    return X, y


def test_digamma():
    assert np.allclose(mi.digamma(np.arange(1, 4000)), [psi(i) for i in range(1, 4000)], atol=1e-12, rtol=0)


def test_neighbour_distance_with_ties_and_context():
    rnd = random.Random(3)
    for _ in range(300):
        every = sorted(rnd.randrange(40) for _ in range(rnd.randrange(5, 30)))
        k = rnd.randrange(1, 4)
        v, w = np.unique(every, return_counts=True)
        lo = rnd.randrange(len(v))
        hi = rnd.randrange(lo, len(v)) + 1
        got = mi.neighbour_distance(v[lo:hi], w[lo:hi], k, list(zip(v[:lo], w[:lo])), list(zip(v[hi:], w[hi:])))
        assert got.tolist() == [sorted(abs(a - x) for a in every)[k] for x in v[lo:hi]]


def test_against_loops_over_all_pairs(spark):
    X, y = data()
    want = brute(X, y)
    df = frame(spark, X, y)
    assert np.allclose(scores(df), want, atol=1e-9) and want[4] == 0 and want[2] > .4


def test_chunks_change_nothing(spark):
    """Neighbourhoods and ranges over many chunks, some of them without a class; a class of one, of two, rows without a label."""
    X, y = data(180)
    y = y.astype(object)
    y[:5] = None
    y[7], y[8], y[9] = 77, 78, 78
    labelled = np.array([c is not None for c in y])
    want = brute(X[labelled], y[labelled])
    for chunk in (4, 25):
        assert np.allclose(scores(frame(spark, X, y), chunk=chunk), want, atol=1e-9)


def test_odd_frames(spark):
    X, y = data(40)
    assert scores(frame(spark, X, [None] * 40)) in ([], [0.0] * 7)
    assert scores(frame(spark, X[:6], range(6))) == [0.0] * 7
    assert fsel.fit_select(frame(spark, X, y), "mutual_info", "y", k=2).indices[-1] in (2, 6)
