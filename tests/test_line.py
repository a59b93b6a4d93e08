import math

import numpy as np
import pyarrow as pa
import pytest

from tessera.operators import knn, line
from tessera.operators.neighbours import BlockIndex


def _brute(rows, k=5):
    """Rows (key, x, y): a missing value ← mean over the k least (distance, key) of the others that have both; rows of one key
    put their neighbours together, a neighbour counts with all donors of its key."""
    donors = [(d, v) for d, *v in rows if None not in v]
    out, near = [], {}
    for t in (0, 1):
        for key, *v in rows:
            if key is not None and v[t] is None and v[1 - t] is not None:
                dist = [(math.sqrt(2 * (v[1 - t] - w[1 - t]) ** 2), -1 if d is None else d, d) for d, w in donors]
                near.setdefault((key, t), []).extend(sorted(dist, key=lambda c: c[:2])[:k])
    for key, *v in rows:
        new = []
        for t in (0, 1):
            best = sorted(near.get((key, t), []), key=lambda c: c[:2])[:k]
            values = [w[t] for _, _, d in best if d is not None for e, w in donors if e == d]
            have = [r[t + 1] for r in rows if r[t + 1] is not None]
            new.append(v[t] if v[t] is not None else sum(values) / len(values) if values else sum(have) / len(have))
        out.append((-1 if key is None else key, *new))
    return sorted(out)


def _check(spark, rows):
    df = spark.createDataFrame(rows, "k long, x double, y double")
    got = sorted((-1 if r.k is None else r.k, r.x, r.y) for r in knn.knn_impute(df, "k", ["x", "y"]).collect())
    assert np.allclose(got, _brute(rows))


def _rows(rng, n, digits=2):
    x = np.round(rng.normal(size=(n, 2)), digits)
    gone = rng.random((n, 2)) < 0.2
    return [(i, *(None if g else float(v) for v, g in zip(a, b))) for i, (a, b) in enumerate(zip(x, gone))]


@pytest.mark.parametrize("digits", [0, 1, 6])
def test_two_columns_need_no_index(spark, monkeypatch, digits):
    """Chunks of few rows, hot values, ties across values: the result of brute force, and no block index."""
    monkeypatch.setattr(line, "CHUNK", 20)
    monkeypatch.setattr(line, "ASKED", 8)
    monkeypatch.setattr(line, "HELD", 64)
    monkeypatch.setattr(BlockIndex, "__init__", lambda *a, **k: pytest.fail("an index was built"))
    _check(spark, _rows(np.random.default_rng(digits), 400, digits))


def test_keys_that_repeat_or_are_null(spark, monkeypatch):
    monkeypatch.setattr(line, "CHUNK", 30)
    rows = _rows(np.random.default_rng(5), 200, 1)
    rows += [rows[i] for i in range(0, 200, 9)]
    rows += [(rows[i][0], 0.5, None) for i in range(0, 200, 31)] + [(None, 0.3, 7.0), (None, None, 0.1)]
    _check(spark, rows)


def test_distances_that_do_not_tell_neighbours_apart(spark, monkeypatch):
    """Far from the donors all distances are equal, beyond what a chunk has: the general search answers."""
    monkeypatch.setattr(line, "CHUNK", 10)
    rows = [(1000 - i, float(i), float(i % 7)) for i in range(100)] + [(2000, 1e20, None), (2001, None, 3.0)]
    _check(spark, rows)


def test_a_line_keeps_the_least_keys_and_widens_for_ties():
    v = np.array([1.0, 1.0, 1.0, 2.0, 4.0, *np.full(3, 1e-200), *np.full(3, 2e-200), *np.full(3, 3e-200)])
    keys = pa.array([f"k{i:02}" for i in range(len(v))][::-1])
    at = line.Line(v, keys, v, np.ones(len(v), np.int64), 2, -np.inf, np.inf)
    row, donor, dist, open_ = at.nearest(np.array([0.0, 3.0, 1.0]))
    near = {i: sorted(zip(dist[row == i], keys.take(pa.array(at.at[donor[row == i]])).to_pylist())) for i in range(3)}
    every = lambda q: sorted((float(d), k) for d, k in zip(line.distance(np.float64(q), v), keys.to_pylist()))[:2]
    assert near == {0: every(0.0), 1: every(3.0), 2: every(1.0)} and not open_.any()


def test_fit_transform_searches_the_training_rows_once(spark, monkeypatch):
    from tessera.plans import prep
    rows = [(i, None if i % 4 == 0 else float(i), float(i % 7), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, x double, z double, y int")
    calls, real = [], line.fills
    monkeypatch.setattr(line, "fills", lambda *a, **k: calls.append(1) or real(*a, **k))
    x, st, _ = prep.fit_transform(df, prep.PrepConfig(target="y", keys=("id",), imp="knn"))
    assert len(calls) == 1
    a = {r["id"]: r["features"] for r in x.collect()}
    assert a == {r["id"]: r["features"] for r in prep.transform(df.drop("y"), st).collect()} and len(calls) == 2
