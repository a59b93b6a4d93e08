"""Impurity importances of forests whose trees grow to the end.

Nodes with more rows than a task should hold are split by histograms of binned
features: a pass over the rows adds them up for many nodes of many trees at a
time, and the driver gets sums of bounded size. A node that fits is handed off: its
rows come together in one task, which grows the rest of the tree on exact
values, level by level, however deep.

A row's weight in a tree is a Poisson(1) draw by a hash of (seed, tree, row), the
distributed form of the bootstrap, so that every pass sees the same bags.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import written

#: Numbers that a handed-off node holds at most (rows times features), and slots of the histograms of one pass.
HELD, SLOTS = 1 << 22, 1 << 20
BINS, WORD = 64, 52
_TINY = 1e-12


def poisson_weights(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Poisson(1) draws by a hash of (seed, tree, id)."""
    x = ids.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, mix in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mix)
    u = (x ^ (x >> np.uint64(31))) >> np.uint64(11)  # of 2^53
    at = np.exp(-1) * np.cumsum([1, 1, 1 / 2, 1 / 6, 1 / 24, 1 / 120, 1 / 720, 1 / 5040])
    out = np.zeros(len(u), np.int8)
    for least in np.ceil(at * 2.0**53).astype(np.uint64):
        out += u >= least
    return out.astype(np.int64)


def stats(y: np.ndarray, w: np.ndarray, classes: int | None) -> np.ndarray:
    """What impurity needs of each row: its weight by class, or (w, w y, w y²)."""
    if classes is None:
        return np.column_stack([w, w * y, w * y * y]).astype(np.float64)
    out = np.zeros((len(y), classes))
    out[np.arange(len(y)), y.astype(int)] = w
    return out


def weighted_impurity(s: np.ndarray, classes: int | None, axis: int = -1) -> np.ndarray:
    """Weight times Gini impurity, or the sum of squares about the mean; ``axis`` is that of the statistics."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if classes is None:
            w, wy, wyy = np.moveaxis(s, axis, 0)
            out = wyy - wy ** 2 / w
        else:
            n = s.sum(axis)
            out = n - (s * s).sum(axis) / n
    return np.nan_to_num(out, nan=0.0)


def _first_best(score: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Least score of each group (infinite: none) and the first place that has it; ``group`` ascends."""
    least, where = np.full(groups, np.inf), np.full(groups, -1)
    heads = np.nonzero(np.append(True, group[1:] != group[:-1]))[0]
    least[group[heads]] = np.minimum.reduceat(score, heads)
    at = np.nonzero(score == least[group])[0][::-1]
    where[group[at]] = at
    return least, where


def _between(low, high):
    """A threshold above ``low`` and up to ``high``, midway where there is a number."""
    mid = low + (high - low) / 2
    return np.where(mid > low, np.minimum(mid, high), high)


def _class_runs(code: np.ndarray, w: np.ndarray, nd: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of rows in order of (node, value), up to and with each: its node's weight, and the sums of squares of the weights by
    class at or before it and after it. ``total``: weights by (class, node). One sum runs over all classes, not one a class."""
    classes, nodes = total.shape
    by = np.argsort(code.astype(np.min_scalar_type(classes)), kind="stable")
    held = np.cumsum(w[by])
    before = np.empty(len(w))  # of its class in its node
    flat = total.ravel()
    before[by] = held - w[by] - (np.cumsum(flat) - flat)[code[by].astype(np.int64) * nodes + nd[by]]
    square, n = (total * total).sum(0), total.sum(0)
    ahead = (np.cumsum(square) - square)[nd]
    below = np.cumsum(w * (2 * before + w)) - ahead
    across = np.cumsum(w * total[code, nd]) - ahead
    return np.cumsum(w) - (np.cumsum(n) - n)[nd], below, square[nd] - 2 * across + below


def finish(x: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int | None, features: int, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Decrease of weighted impurity by feature in a tree grown to the end, and its depth; weights are whole and above 0.

    A node looks at ``features`` of the features that vary in it, drawn anew; a split lies between two values.
    A feature of two values is counted by the rows that hold the higher one, as long as it varies; others are kept in order
    of (node, value), as ranks, and summed up only in the nodes that look at them.
    """
    p = x.shape[1]
    gain, depth = np.zeros(p), 0
    if not len(x):
        return gain, depth
    w = w.astype(np.float64)
    s = np.ascontiguousarray(stats(y, w, None).T) if classes is None else None
    code = None if classes is None else y.astype(np.min_scalar_type(classes))
    impurity_of = lambda t: weighted_impurity(t, classes, 0)

    def sums(at: np.ndarray, nd: np.ndarray, nodes: int) -> np.ndarray:
        """Statistics (first axis) of the rows ``at`` by their node."""
        if code is None:
            return np.stack([np.bincount(nd, t[at], nodes) for t in s])
        return np.bincount(nd * classes + code[at], w[at], nodes * classes).reshape(nodes, classes).T

    low, high = x.min(0), x.max(0)
    two = ((x == low) | (x == high)).all(0)
    ranks, orders = {}, {}
    for f in np.nonzero(~two)[0]:
        v = np.ascontiguousarray(x[:, f])
        o = np.argsort(v, kind="stable")
        ranks[f] = np.empty(len(o), np.int32)
        ranks[f][o] = np.append(0, np.cumsum(v[o[1:]] > v[o[:-1]]))
        orders[f] = o.astype(np.int32)
    upper = {f: np.nonzero(x[:, f] == high[f])[0].astype(np.int32) for f in range(p) if two[f] and low[f] < high[f]}
    rows, node, count = np.arange(len(x), dtype=np.int32), np.zeros(len(x), np.int64), np.array([len(x)])  # rows: those of open nodes
    while len(rows):
        nodes = len(count)
        ends = np.cumsum(count)
        of = np.repeat(np.arange(nodes), count)  # node of each place of every order
        old = node[rows]
        total = sums(rows, old, nodes)
        impurity = impurity_of(total)
        varies = np.zeros((nodes, p), bool)
        for f, o in orders.items():
            varies[:, f] = ranks[f][o[ends - count]] < ranks[f][o[ends - 1]]
        at_node = {f: node[r] for f, r in upper.items()}
        for f, nd in at_node.items():
            held = np.bincount(nd, minlength=nodes)
            varies[:, f] = (held > 0) & (held < count)
        draw = np.where(varies, rng.random((nodes, p)), np.inf)
        allowed = varies if features >= p else varies & (draw <= np.partition(draw, features - 1, axis=1)[:, features - 1:features])
        allowed = allowed & (impurity > _TINY * (np.maximum(1.0, total[0]) if classes is None else 1.0))[:, None]
        score, last = np.full((nodes, p), np.inf), {}  # last: the place of an order up to which a node's rows go left
        for f, nd in at_node.items():
            look = allowed[:, f]
            some = np.nonzero(look)[0]
            if not len(some):
                continue
            here = look[nd]
            above = sums(upper[f][here], (np.cumsum(look) - 1)[nd[here]], len(some))
            score[some, f] = impurity_of(total[:, some] - above) + impurity_of(above)
        for f, o in orders.items():
            look = allowed[:, f]
            some = np.nonzero(look)[0]
            if not len(some):
                continue
            if len(some) == nodes:
                place, nd = None, of
            else:
                place = np.nonzero(np.repeat(look, count))[0]
                o, nd = o[place], np.repeat(np.arange(len(some)), count[some])
            whole, v = total[:, some], ranks[f][o]
            at = np.nonzero((nd[1:] == nd[:-1]) & (v[1:] > v[:-1]))[0]
            if code is None:
                run = np.cumsum(s[:, o], axis=1)
                start = np.cumsum(count[some]) - count[some]
                base = np.where(start > 0, run[:, start - 1], 0.0)
                left = run[:, at] - base[:, nd[at]]
                both = impurity_of(left) + impurity_of(whole[:, nd[at]] - left)
            else:
                n, below, above = (t[at] for t in _class_runs(code[o], w[o], nd, whole))
                rest = whole.sum(0)[nd[at]] - n
                both = (n - below / n) + (rest - above / rest)
            least, where = _first_best(both, nd[at], len(some))
            score[some, f] = least
            last[f] = np.full(nodes, -1)
            last[f][some] = at[where] if place is None else place[at[where]]
        best = score.argmin(1)
        least = score[np.arange(nodes), best]
        split = np.isfinite(least)
        if not split.any():
            break
        depth += 1
        np.add.at(gain, best[split], impurity[split] - least[split])
        number = np.cumsum(split) - 1
        side = np.full(len(x), -1, np.int8)  # 0: left, the values below
        rows = rows[split[old]]
        side[rows] = 0
        for f, nd in at_node.items():
            side[upper[f][(split & (best == f))[nd]]] = 1
        for f, at in last.items():
            mine = np.nonzero(split & (best == f))[0]
            size = ends[mine] - 1 - at[mine]
            side[orders[f][np.repeat(ends[mine] - np.cumsum(size), size) + np.arange(size.sum())]] = 1
        child = 2 * number[node[rows]] + side[rows]
        upper = {f: r[varies[nd, f] & (side[r] >= 0)] for (f, r), nd in zip(upper.items(), at_node.values())}
        node[rows] = child
        count = np.bincount(child, minlength=2 * (number[-1] + 1))
        lefts = np.repeat(np.arange(len(count)) % 2 == 0, count)
        for f, o in orders.items():
            # within each node those that go left, then the others, each in order
            to = side[o]
            orders[f] = np.empty(len(rows), np.int32)
            orders[f][lefts], orders[f][~lefts] = o[to == 0], o[to == 1]
    return gain, depth


@dataclass
class Upper:
    """The part of a tree above the hand-off: nodes with a binned split, or handed off, or leaves."""

    feature: list = field(default_factory=lambda: [-1])
    bin: list = field(default_factory=lambda: [0])
    child: list = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, at: int) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.bin[node], self.child[node] = feature, at, left
        self.feature += [-1, -1]
        self.bin += [0, 0]
        self.child += [0, 0]
        return left, left + 1

    def place_of(self, nodes: list) -> Callable[[np.ndarray], np.ndarray]:
        """A function of binned rows (features first) that gives the place in ``nodes``, ends of the tree, of each row's end, or -1.

        A feature's bin leaves over the nodes whose path it fits, as bits of a word; the bits that all features leave name
        the node. So a row costs the features that paths ask for, however deep the tree.
        """
        words = -(-len(nodes) // WORD)
        place = {n: i for i, n in enumerate(nodes)}
        fits = {f: np.zeros((words, BINS + 1), np.int64) for f in set(self.feature) if f >= 0}
        todo = [(0, {})]
        while todo:
            n, path = todo.pop()  # path: first and last bin by feature
            f = self.feature[n]
            if f >= 0:
                lo, hi = path.get(f, (0, BINS))
                todo += [(self.child[n], {**path, f: (lo, min(hi, self.bin[n]))}), (self.child[n] + 1, {**path, f: (max(lo, self.bin[n] + 1), hi)})]
            elif n in place:
                for g, fit in fits.items():
                    lo, hi = path.get(g, (0, BINS))
                    fit[place[n] // WORD, lo:hi + 1] |= 1 << place[n] % WORD

        def of(binned: np.ndarray) -> np.ndarray:
            out = np.full(binned.shape[1], -1, np.int32) if fits else np.full(binned.shape[1], place.get(0, -1), np.int32)
            for k in range(words if fits else 0):
                left = None
                for f, fit in fits.items():
                    left = fit[k][binned[f]] if left is None else left & fit[k][binned[f]]
                # one bit at most, below 2^52: its number is the double's exponent
                bit = np.frexp(left.astype(np.float64))[1] - 1
                out = np.where(left != 0, bit + k * WORD, out)
            return out

        return of


def _batch(b: pa.RecordBatch, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, p)
    return b.column("id").to_numpy(), x, b.column("y").to_numpy(zero_copy_only=False)


def _binned(x: np.ndarray, cuts: list) -> np.ndarray:
    """Bins of the rows, features first."""
    return np.stack([np.searchsorted(c, x[:, f]).astype(np.uint8) for f, c in enumerate(cuts)])


def _narrow(columns: list) -> tuple[bytes, list]:
    """Columns, in a byte a value where that holds them, and which they are."""
    small = [bool(((c >= -128) & (c < 128)).all() and (c == np.trunc(c)).all()) for c in columns]
    return bytes(small), [c.astype(np.int8) if s else np.ascontiguousarray(c) for s, c in zip(small, columns)]


def _wide(block: bytes, p: int) -> list:
    """Ids, weights, labels and features of a block of handed-off rows."""
    kinds = [np.int64, np.int8, *(np.int8 if s else np.float64 for s in block[:p + 1])]
    n, at, out = (len(block) - p - 1) // sum(np.dtype(k).itemsize for k in kinds), p + 1, []
    for k in kinds:
        out.append(np.frombuffer(block, k, n, at))
        at += out[-1].nbytes
    return out


def _histograms(rows: DataFrame, p: int, cuts: list, uppers: list, group: list, chosen: np.ndarray, classes: int | None, seed: int, bootstrap: bool) -> np.ndarray:
    """Sums of ``stats`` by (node of the group, its drawn features, bin)."""
    width = classes or 3
    m = chosen.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast((cuts, {t: uppers[t] for t, _ in group}, group, chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, uppers, group, chosen = shared.value
        out = np.zeros((len(group), m, BINS + 1, width))
        of_tree: dict = {}
        for g, (t, node) in enumerate(group):
            of_tree.setdefault(t, {})[node] = g
        # the slots of a tree's nodes alone: a pass costs the rows times the trees, whatever the group's size
        of_tree = {t: (np.array(list(nodes.values())), uppers[t].place_of(list(nodes))) for t, nodes in of_tree.items()}
        for b in batches:
            ids, x, y = _batch(b, p)
            binned = _binned(x, cuts)
            flat, code = binned.ravel(), y.astype(np.int64)
            for t, (g, place_of) in of_tree.items():
                w = poisson_weights(ids, t, seed) if bootstrap else np.ones(len(ids))
                mine = place_of(binned)
                at = np.nonzero((w > 0) & (mine >= 0))[0]
                mine, w = mine[at], w[at]
                size = len(g) * (BINS + 1)
                s = [w, w * y[at], w * y[at] * y[at]] if classes is None else []
                for j in range(m):
                    place = mine * (BINS + 1) + flat[(chosen[g, j] * len(ids))[mine] + at]
                    if classes is None:
                        sums = np.stack([np.bincount(place, v, size) for v in s], axis=1)
                    else:
                        sums = np.bincount(place * width + code[at], w, size * width)
                    out[g, j] += sums.reshape(len(g), BINS + 1, width)
        out = out.ravel()
        i = np.nonzero(out)[0]
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(out[i])], names=["i", "v"])

    got = rows.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(len(group) * m * (BINS + 1) * width)
    out[got.column("i").to_numpy()] = got.column("v").to_numpy()
    return out.reshape(len(group), m, BINS + 1, width)


def importances(df: DataFrame, label: str, col: str = "features", trees: int = 100, seed: int = 42, regression: bool = False,
                max_features: int | None = None, bootstrap: bool = True, held: int = HELD, stats_out: dict | None = None) -> list:
    """Mean over the trees of each feature's share of the impurity decrease, summing to 1 (all 0 where no tree splits).

    As in the library a classifier's node looks at the square root of the features and a regressor's at all
    (``max_features`` sets another number), and nodes are split until they are pure or constant. Rows without a label
    do not count; features must not be missing. ``held``: numbers of a node that one task may hold.
    """
    from tessera.operators.select import _width

    p = _width(df, col)
    y = F.col(label).cast("double")
    d = df.where(F.col(label).isNotNull()).select(F.monotonically_increasing_id().alias("id"), F.col(col).cast("array<double>").alias("x"), y.alias("y"))
    # ids stay, once written; few bytes and much work: as many tasks as there are cores, whatever files the rows came from
    spread = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)
    rows = written(d.repartition(spread), "forest-rows")
    classes = None
    if not regression:
        labels = written(rows.select("y").distinct(), "labels")
        values = np.sort(labels.toArrow().column("y").to_numpy())
        classes = len(values)
        shared_labels = df.sparkSession.sparkContext.broadcast(values)
    n = rows.count()
    if not n or not p:
        return [0.0] * p
    m = min(p, max_features or (p if regression else max(1, int(p ** 0.5))))
    limit = max(2, held // p)
    if classes is not None:
        def recode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("x"), pa.array(np.searchsorted(shared_labels.value, b.column("y").to_numpy()).astype(np.float64))],
                                                 names=["id", "x", "y"])
        rows = rows.mapInArrow(recode, rows.schema)
    uppers = [Upper() for _ in range(trees)]
    gains = np.zeros((trees, p))
    cuts: list = []
    big = [(t, 0) for t in range(trees)] if n > limit else []
    if big:
        at = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
        row = rows.agg(*[F.percentile_approx(F.col("x").getItem(f), at, 10_000).alias(f"c{f}") for f in range(p)]).first()
        cuts = [np.unique(row[f"c{f}"]) for f in range(p)]
    rng = np.random.default_rng(seed)
    while big:
        size = max(1, SLOTS // (m * (BINS + 1) * (classes or 3)))
        todo, big = big, []
        for at in range(0, len(todo), size):
            group = todo[at:at + size]
            chosen = np.argsort(rng.random((len(group), p)), axis=1)[:, :m]
            hist = _histograms(rows, p, cuts, uppers, group, chosen, classes, seed, bootstrap)
            left = np.cumsum(hist, axis=2)
            total = left[:, :, -1:, :]
            size_of = lambda s: s.sum(-1) if classes else s[..., 0]
            both = weighted_impurity(left, classes) + weighted_impurity(total - left, classes)
            valid = (size_of(left) > 0) & (size_of(total - left) > _TINY)
            both = np.where(valid, both, np.inf)
            for g, (t, node) in enumerate(group):
                whole = total[g, 0, 0]
                j, b = np.unravel_index(both[g].argmin(), both[g].shape)
                # no split between bins, or a pure node: what is left of it is for the task that gets it
                if not np.isfinite(both[g, j, b]) or weighted_impurity(whole, classes) <= _TINY:
                    continue
                gains[t, chosen[g, j]] += weighted_impurity(whole, classes) - both[g, j, b]
                for child, s in zip(uppers[t].split(node, int(chosen[g, j]), int(b)), (left[g, j, b], whole - left[g, j, b])):
                    if size_of(s) > limit and weighted_impurity(s, classes) > _TINY:
                        big.append((t, child))
    shared = df.sparkSession.sparkContext.broadcast((cuts, uppers))

    def hand_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, uppers = shared.value
        ends = [[n for n, f in enumerate(u.feature) if f < 0] for u in uppers]
        places = [u.place_of(e) for u, e in zip(uppers, ends)]
        for b in batches:
            ids, x, y = _batch(b, p)
            binned = _binned(x, cuts) if cuts else None
            kinds, columns = _narrow([y, *x.T])
            out = []
            for t in range(trees):
                w = (poisson_weights(ids, t, seed) if bootstrap else np.ones(len(ids))).astype(np.int8)
                at = np.nonzero(w)[0]
                node = places[t](binned)[at] if cuts else np.zeros(len(at), np.int32)
                order = np.argsort(node.astype(np.min_scalar_type(len(ends[t]))), kind="stable")
                at, node = at[order], node[order]
                bounds = [0, *(np.nonzero(node[1:] != node[:-1])[0] + 1).tolist(), len(at)]
                held = [c[at] for c in (ids, w, *columns)]  # by column: few values compress well
                out += [(t, ends[t][node[lo]], b"".join([kinds, *(c[lo:hi].tobytes() for c in held)])) for lo, hi in zip(bounds, bounds[1:]) if hi > lo]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 3, (pa.int32(), pa.int32(), pa.binary()))],
                                             names=["tree", "node", "rows"])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def emit() -> pa.RecordBatch:
            ids, w, y, *x = (np.concatenate(c) for c in zip(*(_wide(r, p) for r in held)))
            order = np.argsort(ids, kind="stable")  # whatever the order of the blocks
            gain, depth = finish(np.stack([c[order] for c in x]).T, y[order], w[order], classes, m, np.random.default_rng([seed, *now]))
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([gain.tolist()], pa.list_(pa.float64())), pa.array([depth], pa.int32())],
                                              names=["tree", "gain", "depth"])

        for b in batches:
            for tree, node, data in zip(*(b.column(c).to_pylist() for c in ("tree", "node", "rows"))):
                if (tree, node) != now:
                    if held:
                        yield emit()
                    now, held = (tree, node), []
                held.append(data)
        if held:
            yield emit()

    blocks = rows.mapInArrow(hand_off, "tree int, node int, rows binary")
    parts = blocks.repartition(max(trees, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "tree", "node").sortWithinPartitions("tree", "node")
    done = written(parts.mapInArrow(grow, "tree int, gain array<double>, depth int"), "grown")
    sums = done.groupBy("tree").agg(F.array(*[F.sum(F.col("gain").getItem(f)) for f in range(p)]).alias("gain"), F.max("depth").alias("depth")).collect()
    for r in sums:
        gains[r["tree"]] += np.array(r["gain"])
    if stats_out is not None:
        stats_out.update(depth=max((r["depth"] for r in sums), default=0), upper=max(len(u.feature) for u in uppers))
    total = gains.sum(1, keepdims=True)
    share = np.divide(gains, total, out=np.zeros_like(gains), where=total > 0)
    mean = share.mean(0)
    return (mean / mean.sum()).tolist() if mean.sum() > 0 else mean.tolist()
