import numpy as np
import pytest

from tessera.operators import forest as fo
from tessera.operators import select as fsel


def naive(x, y, classes):
    """Impurity decrease by feature of one full tree, by recursion over rows; ties to the first feature and value."""
    gain = np.zeros(x.shape[1])
    deepest = 0

    def impurity(v):
        if not len(v):
            return 0.0
        return ((v - v.mean()) ** 2).sum() if classes is None else len(v) - sum((v == c).sum() ** 2 for c in range(classes)) / len(v)

    todo = [(np.arange(len(x)), 0)]
    while todo:
        rows, depth = todo.pop()
        deepest = max(deepest, depth)
        whole = impurity(y[rows])
        best = (np.inf,)
        if whole > 1e-9:
            for f in range(x.shape[1]):
                for t in np.unique(x[rows, f])[1:]:
                    left = x[rows, f] < t
                    s = impurity(y[rows[left]]) + impurity(y[rows[~left]])
                    if s < best[0] - 1e-12:
                        best = (s, f, rows[left], rows[~left])
        if len(best) > 1:
            gain[best[1]] += whole - best[0]
            todo += [(best[2], depth + 1), (best[3], depth + 1)]
    return gain / gain.sum(), deepest


def frame(spark, x, y):
    return spark.createDataFrame([(list(map(float, a)), None if b is None else float(b)) for a, b in zip(x, y)], "features array<double>, y double").repartition(3)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 12, 160), rng.normal(size=160).round(1), rng.integers(0, 2, 160), np.full(160, 4.0)])
    return x, (x[:, 0] > 5).astype(int) + (x[:, 1] > .3) * (x[:, 2] > 0), x[:, 0] * 2 + x[:, 1] ** 2


@pytest.mark.parametrize("held", [1 << 22, 4 * 40])
def test_one_full_tree_equals_plain_recursion(spark, data, held):
    """In one task, and above the hand-off by histograms (whose bins hold one value each here)."""
    x, c, r = data
    for y, classes in ((c, 3), (r, None)):
        want, deepest = naive(x, y, classes)
        seen = {}
        got = fo.importances(frame(spark, x, y), "y", trees=1, regression=classes is None, max_features=4, bootstrap=False, held=held, stats_out=seen)
        # equally good splits (a pair of rows that two features part) may go to either feature, by the last bit of a sum of squares
        assert np.allclose(got, want, atol=.02 if held < 1000 else 1e-9 if classes else 1e-3) and got[3] == 0
        assert (seen["upper"] > 1) == (held < 1000)


def test_trees_deeper_than_thirty(spark):
    n = 120
    seen = {}
    fo.importances(frame(spark, np.arange(n)[:, None], np.arange(n) % 2), "y", trees=1, bootstrap=False, stats_out=seen)
    assert seen["depth"] > 30


def test_forest_finds_what_counts(spark, data):
    x, c, r = data
    a = fo.importances(frame(spark, x, c), "y", trees=20)
    b = fo.importances(frame(spark, x, [None if i % 9 == 0 else v for i, v in enumerate(r)]), "y", trees=20, regression=True)
    assert abs(sum(a) - 1) < 1e-9 and a[0] == max(a) and a[3] == 0 and b[0] > .8
    assert fo.importances(frame(spark, x, c), "y", trees=20) == a
    assert np.allclose(fo.importances(frame(spark, x, c), "y", trees=20, held=4 * 50), a, atol=.1)
    assert fsel.fit_select(frame(spark, x, c), "random_forest", "y", k=1).indices == [0]


def test_odd_frames(spark):
    x = np.ones((9, 2))
    assert fo.importances(frame(spark, x, range(9)), "y", trees=3) == [0.0, 0.0]
    assert fo.importances(frame(spark, x, [None] * 9), "y", trees=3) == [0.0, 0.0]
    assert fo.importances(frame(spark, np.arange(18).reshape(9, 2), [1] * 9), "y", trees=3) == [0.0, 0.0]


def test_weights_are_poisson():
    w = fo.poisson_weights(np.arange(200_000), 3, 42)
    assert abs(w.mean() - 1) < .01 and abs(w.var() - 1) < .02 and (w == fo.poisson_weights(np.arange(200_000), 3, 42)).all()
    assert (w != fo.poisson_weights(np.arange(200_000), 4, 42)).mean() > .5


def test_large_nodes_are_spread_and_counted_by_their_own_slots(spark, monkeypatch):
    """One input task becomes many; a pass allocates what a tree's nodes need, whatever the group holds."""
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(size=3000), rng.normal(size=3000), *np.eye(3)[rng.integers(0, 3, 3000)].T])
    y = (x[:, 0] > 0).astype(int) + (x[:, 3] > 0)
    sizes, real = [], fo._histograms

    def seen(rows, p, cuts, uppers, group, chosen, classes, *more):
        sizes.append(rows.rdd.getNumPartitions())
        out = real(rows, p, cuts, uppers, group, chosen, classes, *more)
        # every node's drawn features count the same rows
        assert np.allclose(out.sum(axis=2), out.sum(axis=2)[:, :1]) and (out.sum(axis=(1, 2, 3)) > 0).all()
        return out

    monkeypatch.setattr(fo, "_histograms", seen)
    df = spark.createDataFrame([(list(map(float, a)), float(b)) for a, b in zip(x, y)], "features array<double>, y double").coalesce(1)
    for regression in (False, True):
        got = fo.importances(df, "y", trees=7, regression=regression, held=5 * 400)
        assert got[0] == max(got) and abs(sum(got) - 1) < 1e-9
    assert len(sizes) > 2 and min(sizes) > 1  # it was the one task that the rows came in


def test_tree_with_folded_features_equals_plain_recursion():
    """Features of two values, constant ones and others, with repeated values, unequal weights and none."""
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.integers(0, 9, 300), np.full(300, 2.0), rng.integers(0, 2, 300) * 3.5 - 1, rng.normal(size=300).round(1)])
    c = ((x[:, 0] > 4) + (x[:, 3] > .5) + (rng.random(300) < .1)).astype(float)
    w = rng.integers(1, 4, 300)
    each = np.repeat(np.arange(300), w)
    for classes in (3, None):
        gain, depth = fo.finish(x, c, w.astype(float), classes, 4, np.random.default_rng(0))
        want, deepest = naive(x[each], c[each].astype(int) if classes else c[each], classes)
        assert np.allclose(gain / gain.sum(), want, atol=.03) and abs(depth - deepest) <= 3 and gain[1] == 0
    assert fo.finish(x[:0], c[:0], c[:0], 3, 4, np.random.default_rng(0))[1] == 0


def test_many_classes_are_summed_without_a_column_each():
    """What a level sums up grows with its rows, not with the rows times the classes."""
    import tracemalloc
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(6000, 2)), np.repeat(np.arange(300), 20)[rng.permutation(6000)].astype(float)
    x[:, 0] = y + rng.normal(size=6000) / 9  # few levels
    tracemalloc.start()
    fo.finish(x, y, np.ones(6000), 300, 2, np.random.default_rng(0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 * 6000 * 8 * 2


def test_sums_by_class_equal_plain_ones():
    rng = np.random.default_rng(4)
    nd, code, w = np.sort(rng.integers(0, 7, 200)), rng.integers(0, 4, 200), rng.integers(1, 4, 200).astype(float)
    total = np.array([[w[(nd == k) & (code == c)].sum() for k in range(7)] for c in range(4)])
    n, below, above = fo._class_runs(code, w, nd, total)
    for i in range(200):
        left = np.array([w[:i + 1][(nd[:i + 1] == nd[i]) & (code[:i + 1] == c)].sum() for c in range(4)])
        assert (n[i], below[i], above[i]) == (left.sum(), (left ** 2).sum(), ((total[:, nd[i]] - left) ** 2).sum())


def test_rows_are_placed_by_bits_however_many_ends():
    rng = np.random.default_rng(6)
    tree, ends = fo.Upper(), [0]
    while len(ends) < 3 * fo.WORD:
        n = ends.pop(int(rng.integers(len(ends))))
        ends += tree.split(n, int(rng.integers(4)), int(rng.integers(fo.BINS)))
    binned = rng.integers(0, fo.BINS, (4, 5000)).astype(np.uint8)
    want = []
    for row in binned.T:
        n = 0
        while tree.feature[n] >= 0:
            n = tree.child[n] + (row[tree.feature[n]] > tree.bin[n])
        want.append(n)
    got = tree.place_of(ends)(binned)
    assert [ends[i] for i in got] == want
    some = tree.place_of(ends[::2])(binned)
    assert [ends[::2][i] if i >= 0 else None for i in some] == [n if n in ends[::2] else None for n in want]
    assert (fo.Upper().place_of([0])(binned) == 0).all()


def test_blocks_hold_small_numbers_in_a_byte():
    ids, w, y = np.arange(5) + (1 << 40), np.array([1, 2, 1, 3, 1], np.int8), np.array([0.0, 1, 2, 1, 0])
    x = [np.array([.5, -1, 2, 3, 1e9]), np.array([0.0, 1, 0, 0, 1]), np.array([-128.0, 127, 0, 5, 5]), np.array([128.0, 1, 0, 0, 1])]
    kinds, columns = fo._narrow([y, *x])
    block = b"".join([kinds, *(c.tobytes() for c in (ids, w, *columns))])
    assert len(block) == 5 + 5 * (8 + 1 + 1 + 8 + 1 + 1 + 8)
    for got, want in zip(fo._wide(block, 4), [ids, w, y, *x], strict=True):
        assert (got == want).all()
