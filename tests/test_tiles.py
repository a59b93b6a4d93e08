import math

import numpy as np
import pyarrow as pa
import pytest

from tessera.operators import knn, tiles
from tessera.operators.neighbours import BlockIndex


def _brute(rows, k=5):
    """Rows (key, values…): as ``tests.test_line`` has it, over the columns that both have."""
    p, near, out = len(rows[0]) - 1, {}, []
    for key, *v in rows:
        for t in range(p) if key is not None else ():
            if v[t] is not None:
                continue
            dist = []
            for d, *w in rows:
                common = [j for j in range(p) if j != t and v[j] is not None and w[j] is not None]
                if w[t] is not None and common:
                    dist.append((math.sqrt(p / len(common) * sum((v[j] - w[j]) ** 2 for j in common)), -1 if d is None else d, d))
            near.setdefault((key, t), []).extend(sorted(dist, key=lambda c: c[:2])[:k])
    for key, *v in rows:
        new = []
        for t in range(p):
            best = sorted(near.get((key, t), []), key=lambda c: c[:2])[:k]
            values = [w[t] for _, _, d in best if d is not None for e, *w in rows if e == d and w[t] is not None and sum(x is not None for x in w) > 1]
            have = [r[t + 1] for r in rows if r[t + 1] is not None]
            new.append(v[t] if v[t] is not None else sum(values) / len(values) if values else sum(have) / len(have))
        out.append((-1 if key is None else key, *new))
    return sorted(out)


def _rows(rng, n, p, digits, missing=0.25, scale=1.0, off=0.0):
    x = np.round(off + scale * rng.normal(size=(n, p)), digits)
    x[rng.random(x.shape) < missing] = np.nan
    return [(i, *(None if math.isnan(v) else float(v) for v in r)) for i, r in enumerate(x)]


def _check(spark, rows, rtol=1e-5):
    names = [f"c{i}" for i in range(len(rows[0]) - 1)]
    df = spark.createDataFrame(rows, "k long, " + ", ".join(f"{c} double" for c in names))
    got = sorted((-1 if r.k is None else r.k, *(r[c] for c in names)) for r in knn.knn_impute(df, "k", names).collect())
    assert np.allclose(got, _brute(rows), rtol=rtol)


@pytest.fixture
def small(monkeypatch):
    for name, size in dict(TILE=16, LEAF=8, LOOK=4, GROUP=90, ASKED=40, WAIT=2).items():
        monkeypatch.setattr(tiles, name, size)
    monkeypatch.setattr(BlockIndex, "__init__", lambda *a, **k: pytest.fail("a search a column"))


@pytest.mark.parametrize("digits", [0, 6])
def test_one_search_serves_all_columns(spark, small, digits):
    """Small tiles and several groups, ties of rounded values: the result of brute force."""
    _check(spark, _rows(np.random.default_rng(digits), 220, 4, digits))


def test_keys_that_repeat_or_are_null_and_a_rare_column(spark, small):
    rng = np.random.default_rng(7)
    rows = _rows(rng, 150, 4, 1)
    rows = [(*r[:4], r[4] if i % 50 == 0 else None) for i, r in enumerate(rows)]
    rows += [rows[i] for i in range(0, 150, 11)] + [(3, 0.5, None, None, None), (4, None, None, None, 0.5), (None, 0.1, 0.2, None, 0.3)]
    _check(spark, rows)


def _of(x, q, k=5):
    donors = tiles.Donors(x, pa.array(np.arange(len(x))), x.shape[1], k)
    for t, row, donor, dist in donors.nearest(q):
        every = tiles.distances(q, x, 1.0, x.shape[1])
        for i in np.nonzero(np.isnan(q[:, t]))[0]:
            order = np.lexsort((np.arange(len(x)), np.where(np.isnan(x[:, t]), np.inf, every[i])))[:k]
            order = order[np.isfinite(every[i][order]) & ~np.isnan(x[order, t])]
            assert donor[row == i].tolist() == order.tolist(), (t, i)
            assert np.array_equal(dist[row == i], every[i][order])


@pytest.mark.parametrize("scale, off", [(1.0, 0.0), (1e-7, 1.0), (1.0, 1e9), (1e160, 0.0), (1e-30, 0.0)])
def test_single_precision_never_loses_a_neighbour(scale, off):
    """Rounding of the matrix product only adds pairs, wherever the values lie."""
    rng = np.random.default_rng(1)
    x = off + scale * rng.normal(size=(3000, 6))
    x[1500:] = off + scale * (5 + 1e-4 * rng.normal(size=(1500, 6)))
    x[rng.random(x.shape) < 0.2] = np.nan
    x[77], x[78, 0] = np.nan, np.inf
    _of(x, np.concatenate([x[:40], x[1500:1540]]))


def test_few_pairs_get_a_distance(monkeypatch):
    """Of rows of three factors most tiles are left out, of the others few pairs get a distance."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20_000, 3)) @ rng.normal(size=(3, 8))
    x = x[np.argsort(tiles.Tree.grow(x, 64, 1).leaf_of(x), kind="stable")]
    gone, pairs, real = rng.random(x.shape) < 0.1, [], tiles.exact
    x[gone] = np.nan
    monkeypatch.setattr(tiles, "exact", lambda q, d, p: pairs.append(len(q)) or real(q, d, p))
    q = x[5000:5200]
    q = q[np.isnan(q).any(1)]
    _of(x, q)
    assert sum(pairs) < 0.02 * len(q) * len(x)
