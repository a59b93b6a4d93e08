"""Feature selection (F0-F12) over an ``array<double>`` feature column.

Statistical scores are wide aggregates of the vectors (per class where a label
counts): each task adds up its rows, and what is shuffled is one row per class
per task — independent of the row count. Lasso is solved on the (p + 2)²
moments of one pass; forests are grown to the end by ``operators.forest``,
logistic regression is a ``pyspark.ml`` learner. Every method returns a ``Selection``: 0-based
indices into the input features (or a projection for PCA) plus a small score
table (one row per feature).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import pick

METHODS = ("none", "lasso", "lasso_cv", "random_forest", "rf_importance", "logistic_regression",
           "k_best", "mutual_info", "f_classif", "chi2", "pca", "variance_threshold",
           "correlation_threshold")


@dataclass
class Selection:
    method: str
    indices: list | None = None           # kept feature positions, in output order
    scores: dict = field(default_factory=dict)   # feature position -> score
    projection: list | None = None        # PCA: k rows of p loadings
    centre: list | None = None


def _width(df: DataFrame, col: str) -> int:
    r = df.select(F.size(col).alias("w")).limit(1).collect()
    return r[0]["w"] if r else 0


def _topk(scores: dict, k: int | None, ascending_output: bool = False) -> list:
    """Positions of the k best scores (None scores count as lowest; ties →
    the later position wins, as a stable ascending argsort's tail does).
    Output in position order, or ascending score order when asked."""
    items = sorted(scores.items(), key=lambda kv: (kv[1] is not None and not math.isnan(kv[1]),
                                                   kv[1] if kv[1] is not None and not math.isnan(kv[1]) else 0.0,
                                                   kv[0]))
    chosen = items[-k:] if k else items
    return [i for i, _ in chosen] if ascending_output else sorted(i for i, _ in chosen)


# ------------------------------------------------------------ statistics
def _summary(df: DataFrame, col: str, metrics, label: str | None = None) -> DataFrame:
    """(fi[, y], n, metrics…): one wide aggregate of the vectors, for each class
    of ``label``; only its result, a row a class, is unfolded by feature."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    s = Summarizer.metrics("count", *metrics).summary(array_to_vector(F.col(col))).alias("s")
    if label:
        g, keep = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("y")).agg(s), ["y"]
    else:
        g, keep = df.agg(s), []
    arrays = F.arrays_zip(*[vector_to_array(f"s.{m}").alias(m) for m in metrics])
    return (g.select(*keep, F.col("s.count").alias("n"), F.posexplode(arrays).alias("fi", "m"))
            .select(*keep, "fi", "n", *[F.col("m").getField(m).alias(m) for m in metrics]))


def variance_scores(df: DataFrame, col: str = "features") -> DataFrame:
    """population variance per feature."""
    return _summary(df, col, ["variance"]).select("fi", (F.col("variance") * (F.col("n") - 1) / F.col("n")).alias("score"))


def anova_scores(df: DataFrame, label: str, col: str = "features") -> DataFrame:
    """one-way ANOVA F per feature from per-class (n, mean, variance)."""
    t = _summary(df, col, ["mean", "variance"], label)
    gm = F.sum(F.col("n") * F.col("mean")).over(_w("fi")) / F.sum("n").over(_w("fi"))   # a row a class
    t = t.withColumn("d", F.col("mean") - gm).groupBy("fi").agg(
        F.sum("n").alias("N"), F.count(F.lit(1)).alias("K"), F.sum(F.col("n") * F.col("d") * F.col("d")).alias("ssb"),
        F.sum((F.col("n") - 1) * F.col("variance")).alias("ssw"))
    f = F.try_divide(F.col("ssb") / (F.col("K") - 1), F.col("ssw") / (F.col("N") - F.col("K")))
    return t.select("fi", f.alias("score"))


def chi2_scores(df: DataFrame, label: str, col: str = "features") -> DataFrame:
    """F8: chi² of per-class feature sums against class-share × total, and
    ``lo``, the feature's minimum: the statistic is defined for counts, so a
    negative one makes the score meaningless (``fit_select`` raises)."""
    t = _summary(df, col, ["sum", "min"], label)
    share = F.col("n") / F.sum("n").over(_w("fi")) * F.sum("sum").over(_w("fi"))
    t = t.withColumn("e", share)
    return t.groupBy("fi").agg(F.sum(F.try_divide((F.col("sum") - F.col("e")) * (F.col("sum") - F.col("e")), F.col("e"))).alias("score"),
                               F.min("min").alias("lo"))


def quantile_cuts(df: DataFrame, p: int, col: str = "features", bins: int = 10, accuracy: int = 2_000) -> list:
    """Inner bin edges of each feature: the values of rank ceil(n·k / bins), exact.

    A coarse sketch, whose size does not grow with the rows, brackets every
    edge (rank error n / ``accuracy``); values inside the brackets are counted
    each, those between brackets together, and the ranks are read off the
    running sums. A bracket that misses its rank is opened to all values."""
    if p < 1 or bins < 2:
        return [[] for _ in range(p)]
    x = [F.col(col).getItem(i).cast("double") for i in range(p)]
    at = [q for k in range(1, bins) for q in (max(0.0, k / bins - 2 / accuracy), min(1.0, k / bins + 2 / accuracy))]
    row = df.agg(*[F.percentile_approx(x[i], F.array(*[F.lit(q) for q in at]), accuracy).alias(f"c{i}") for i in range(p)]).first()
    pieces = {i: _merged(list(zip(row[f"c{i}"][::2], row[f"c{i}"][1::2]))) for i in range(p) if row[f"c{i}"]}
    out: list = [[] for _ in range(p)]
    while pieces:
        def placed(i):
            """2j for a value before the j-th bracket and above the former, 2j + 1 for one inside, which stays."""
            place = F.lit(2 * len(pieces[i]))
            for j in range(len(pieces[i]) - 1, -1, -1):
                low, high = (F.lit(v) for v in pieces[i][j])
                place = F.when(x[i] < low, 2 * j).when(x[i] <= high, 2 * j + 1).otherwise(place)
            return F.struct(F.lit(i).alias("fi"), F.when(x[i].isNotNull(), place).alias("place"), x[i].alias("v"))

        long = df.select(F.explode(F.array(*[placed(i) for i in pieces])).alias("s")).select("s.*").where("place IS NOT NULL")
        counts = long.groupBy("fi", "place", F.when(F.col("place") % 2 == 1, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
        # a row for each distinct value in a bracket: some 4 · bins / accuracy of the rows at most
        upto = F.sum("c").over(_w("fi").orderBy("place", "v"))
        ranked = counts.withColumn("upto", upto).withColumn("n", F.sum("c").over(_w("fi")))
        mine = F.filter(F.sequence(F.lit(1), F.lit(bins - 1)), lambda k: F.ceil(F.col("n") * k / bins).between(F.col("upto") - F.col("c") + 1, F.col("upto")))
        missed = set()
        found: dict = {}
        for r in ranked.withColumn("k", mine).where(F.size("k") > 0).select("fi", "place", "v", "k").collect():
            if r["place"] % 2 == 0:
                missed.add(r["fi"])
            found.setdefault(r["fi"], {}).update(dict.fromkeys(r["k"], r["v"]))
        for i, edges in found.items():
            if i not in missed:
                out[i] = [edges[k] for k in range(1, bins)]
        pieces = {i: [(float("-inf"), float("nan"))] for i in missed}
    return out


def _merged(pieces: list) -> list:
    """Closed brackets without overlap, ascending (NaN is above all numbers, as in Spark)."""
    key = lambda v: (math.isnan(v), v)
    out: list = []
    for low, high in sorted(pieces, key=lambda b: key(b[0])):
        if out and key(low) <= key(out[-1][1]):
            out[-1] = (out[-1][0], max(high, out[-1][1], key=key))
        else:
            out.append((low, high))
    return out


def mutual_info_scores(df: DataFrame, label: str, col: str = "features", bins: int = 10) -> DataFrame:
    """F6 by bins (``bins=…`` of ``fit_select``; the default is the estimator
    by nearest neighbours, ``operators.mutual_info``): mutual information of
    quantile-binned features with the class, Σ p(b,y) ln(p(b,y) / (p(b) p(y))). A value's bin is the number of
    edges below it, so one far value moves no other."""
    df = df.where(F.col(label).isNotNull())
    p = _width(df, col)
    cuts = quantile_cuts(df, p, col, bins) if p else []

    def bin_of(i):
        x = F.col(col).getItem(i)
        return sum((F.when(x > F.lit(c), 1).otherwise(0) for c in dict.fromkeys(cuts[i])), F.lit(0))

    lg = df.select(F.col(label).alias("y"), F.posexplode(F.array(*[bin_of(i) for i in range(p)]) if p else F.array().cast("array<int>")).alias("fi", "b"))
    cnt = lg.groupBy("fi", "b", "y").agg(F.count(F.lit(1)).alias("n"))
    # cnt has one row per (feature, bin, class): the windows below are tiny
    c = (cnt.withColumn("tot", F.sum("n").over(_w("fi")))
         .withColumn("nb", F.sum("n").over(_w("fi", "b")))
         .withColumn("ny", F.sum("n").over(_w("fi", "y"))))
    return c.groupBy("fi").agg(F.sum(F.col("n") / F.col("tot") * F.log(F.col("n") * F.col("tot") /
                                                                       (F.col("nb") * F.col("ny")))).alias("score"))


def _w(*cols):
    from pyspark.sql import Window
    return Window.partitionBy(*cols)


def correlation_table(df: DataFrame, p: int, label: str | None, col: str = "features"):
    """Pearson r for every feature pair and with the label, from one Gram
    matrix (a tree aggregate of per-partition sums, at every width). Rows
    without a label do not count; zero variance → None."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Correlation
    if label:
        df = df.where(F.col(label).isNotNull())
    if not p or df.isEmpty():
        return {(i, j): None for i in range(p) for j in range(i + 1, p)}, ({i: None for i in range(p)} if label else {})
    arr = F.concat(F.col(col), F.array(F.col(label).cast("double"))) if label else F.col(col)
    m = Correlation.corr(df.select(array_to_vector(arr).alias("_v")), "_v").first()[0].toArray()

    def clean(r):
        return None if r is None or math.isnan(r) else float(r)
    pair = {(i, j): clean(m[i][j]) for i in range(p) for j in range(i + 1, p)}
    ry = {i: clean(m[i][p]) for i in range(p)} if label else {}
    return pair, ry


def correlation_select(df: DataFrame, label: str | None, col: str = "features", threshold: float = 0.9,
                       target_threshold: float = 0.05, width: int | None = None):
    """drop feature j when an earlier feature has |r| > threshold;
    keep features with |r(x, y)| > target_threshold (all when no label)."""
    p = width if width is not None else _width(df, col)
    pair, ry = correlation_table(df, p, label, col)
    drop = {j for (i, j), v in pair.items() if v is not None and abs(v) > threshold}
    by_target = [i for i in range(p) if (ry.get(i) is not None and abs(ry[i]) > target_threshold)] \
        if label else list(range(p))
    return [i for i in by_target if i not in drop], ry, drop


# ---------------------------------------------------------------- models
def _vec(df: DataFrame, col: str):
    from pyspark.ml.functions import array_to_vector
    return df.withColumn("_v", array_to_vector(F.col(col)))


def fold_moments(df: DataFrame, label: str, col: str = "features", folds: int = 1) -> dict:
    """Moments of (features, label, 1) for each fold: a (p + 2)² matrix of sums
    of products. One pass over the rows, added up in Arrow batches; what comes
    to the driver is (p + 2)² numbers a fold. A row's fold is a hash of its
    values, whatever its partition. Rows without a label do not count."""
    import numpy as np
    import pyarrow as pa

    def sums(batches):
        held = {}
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            z = np.column_stack([x, b.column("y").to_numpy(zero_copy_only=False), np.ones(n)])
            fold = b.column("fold").to_numpy(zero_copy_only=False)
            for f in np.unique(fold):
                part = z[fold == f]
                held[f] = held.get(f, 0.0) + part.T @ part
        for f, m in held.items():
            flat = m.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), f, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)],
                                             names=["fold", "i", "v"])

    y = F.col(label).cast("double")
    d = df.where(y.isNotNull()).select(F.col(col).cast("array<double>").alias("x"), y.alias("y"),
                                       F.pmod(F.xxhash64(F.col(col), y), F.lit(folds)).cast("int").alias("fold"))
    rows = d.mapInArrow(sums, "fold int, i int, v double").groupBy("fold", "i").agg(F.sum("v").alias("v")).collect()
    out: dict = {}
    for r in rows:
        out.setdefault(r["fold"], {})[r["i"]] = r["v"]
    size = {f: int(round(math.sqrt(len(v)))) for f, v in out.items()}
    return {f: np.array([v[i] for i in range(len(v))]).reshape(size[f], size[f]) for f, v in out.items()}


def _covariance(m):
    """Centred second moments (population) of the features and with the label."""
    n = m[-1, -1]
    mean = m[-1, :-1] / n
    c = m[:-1, :-1] / n - mean[:, None] * mean[None, :]
    return c[:-1, :-1], c[:-1, -1]


def lasso_descent(a, c, alpha, start=None, tol: float = 1e-12, sweeps: int = 100_000):
    """Minimum of ½ wᵀAw − cᵀw + α‖w‖₁ by cyclic coordinate descent."""
    import numpy as np
    w = np.zeros(len(c)) if start is None else start.copy()
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(c)):
            if a[j, j] <= 0:
                continue
            r = c[j] - a[j] @ w + a[j, j] * w[j]
            new = math.copysign(max(abs(r) - alpha, 0.0), r) / a[j, j]
            moved = max(moved, abs(new - w[j]))
            w[j] = new
        if moved <= tol * max(1.0, float(np.abs(w).max(initial=0.0))):
            break
    return w


def lasso_coefficients(df, label, col="features", alpha=0.01):
    """L1 linear regression on the numeric label, sklearn's objective
    (1/2n)‖y − Xw − b‖² + α‖w‖₁ (no feature standardization), from the moments."""
    m = fold_moments(df, label, col)
    return list(lasso_descent(*_covariance(m[0]), alpha)) if m else [0.0] * _width(df, col)


def lasso_cv_coefficients(df, label, col="features", folds=5, n_alphas=100, eps=1e-3):
    """α of least mean squared error over ``folds`` folds, from
    ``n_alphas`` values below the smallest that gives all zeros; refit on all
    rows. Rows are read once: the moments of each fold give the fits without
    it and the error on it."""
    import numpy as np
    by = fold_moments(df, label, col, folds)
    if not by:
        return [0.0] * _width(df, col)
    total = sum(by.values())
    a, c = _covariance(total)
    top = max(float(np.abs(c).max(initial=0.0)), 1e-12)
    grid = [top * eps ** (i / (n_alphas - 1)) for i in range(n_alphas)]
    error = np.zeros(n_alphas)
    for m in by.values():
        rest = total - m
        if rest[-1, -1] < 1:
            continue
        fa, fc = _covariance(rest)
        mean, w = rest[-1, :-1] / rest[-1, -1], None
        for i, alpha in enumerate(grid):
            w = lasso_descent(fa, fc, alpha, w, tol=1e-9)
            z = np.append(w, [-1.0, mean[-1] - mean[:-1] @ w])    # prediction minus label
            error[i] += (z @ m @ z) / m[-1, -1]
    best = grid[int(np.argmin(error))]
    return list(lasso_descent(a, c, best))


def rf_importances(df, label, col="features", trees=100, seed=42, regression=False):
    """F3 (classifier) / F4 (regressor): impurity importances of a forest
    whose trees grow to the end (``operators.forest``)."""
    from tessera.operators.forest import importances
    return importances(df, label, col, trees, seed, regression)


def logistic_first_row(df, label, col="features", C=1.0, max_iter=1000):
    """multinomial logistic regression (L2, C=1 → regParam 1/(C·n));
    scores are |coefficients| of the first class row."""
    from pyspark.ml.classification import LogisticRegression
    d = _vec(df, col).withColumn("_y", F.col(label).cast("double"))
    n = d.count()
    m = LogisticRegression(featuresCol="_v", labelCol="_y", family="multinomial", regParam=1.0 / (C * n),
                           elasticNetParam=0.0, standardization=False, maxIter=max_iter)
    return [abs(v) for v in m.fit(d).coefficientMatrix.toArray()[0]]


def fit_pca(df, col="features", k=10):
    """principal components of the **centred** features (ml PCA does
    not centre); each component's sign makes its largest |loading| positive."""
    from pyspark.ml.feature import PCA
    p = _width(df, col)
    k = min(k, p)
    means = df.agg(*[F.avg(F.col(col).getItem(i)).alias(f"m{i}") for i in range(p)]).first()
    centre = [means[f"m{i}"] for i in range(p)]
    c = df.select(F.zip_with(F.col(col), F.array(*[F.lit(v) for v in centre]), lambda a, b: a - b).alias(col))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(_vec(c, col))
    pcs = model.pc.toArray().T.tolist()  # k × p
    fixed = []
    for comp in pcs:
        j = max(range(p), key=lambda i: abs(comp[i]))
        fixed.append([-v for v in comp] if comp[j] < 0 else comp)
    return fixed, centre, list(model.explainedVariance.toArray())


def pca_project(col: str, projection, centre):
    """PC_j = Σ_i (x_i − centre_i) · loading_ji, written element by element
    (the widths are known from the fit, so this compiles into generated code)."""
    x = F.col(col)
    d = [x.getItem(i) - F.lit(c) for i, c in enumerate(centre)]
    out = []
    for comp in projection:
        terms = [d[i] * F.lit(w) for i, w in enumerate(comp)]
        out.append(sum(terms[1:], terms[0]) if terms else F.lit(0.0))
    return F.array(*out)


# ------------------------------------------------------------ dispatcher
def _collect_scores(sdf) -> dict:
    return {int(r["fi"]): r["score"] for r in sdf.collect()}


def fit_select(df: DataFrame, method: str, label: str | None, col: str = "features", k: int | None = None,
               **kw) -> Selection:
    """Fit a selection; with no label, label-based methods pass through
    (with a warning), as the reference does."""
    if method not in METHODS:
        raise ValueError(f"unknown feature selection method: {method}")
    if method == "none":
        return Selection("none")
    if label is None and method not in ("pca", "variance_threshold", "correlation_threshold"):
        import warnings
        warnings.warn("no target: feature selection skipped")
        return Selection(method)
    if method == "variance_threshold":
        s = _collect_scores(variance_scores(df, col))
        t = kw.get("threshold", 0.01)
        return Selection(method, [i for i in sorted(s) if s[i] is not None and s[i] > t], s)
    if method == "f_classif":
        s = _collect_scores(anova_scores(df, label, col))
        return Selection(method, _topk(s, k), s)
    if method == "chi2":
        rows = chi2_scores(df, label, col).collect()
        if any(r["lo"] is not None and r["lo"] < 0 for r in rows):
            raise ValueError("chi2 needs non-negative features")
        s = {int(r["fi"]): r["score"] for r in rows}
        return Selection(method, _topk(s, k), s)
    if method in ("k_best", "mutual_info"):
        from tessera.operators.mutual_info import neighbour_scores
        scores = mutual_info_scores(df, label, col, kw["bins"]) if kw.get("bins") else neighbour_scores(df, label, col)
        s = _collect_scores(scores)
        return Selection(method, _topk(s, k, ascending_output=(method == "mutual_info")), s)
    if method == "correlation_threshold":
        idx, ry, _ = correlation_select(df, label, col, kw.get("threshold", 0.9), kw.get("target_threshold", 0.05),
                                        kw.get("width"))
        return Selection(method, idx, ry)
    if method == "lasso":
        coef = lasso_coefficients(df, label, col, kw.get("alpha", 0.01))
        return Selection(method, [i for i, v in enumerate(coef) if v != 0], dict(enumerate(coef)))
    if method == "lasso_cv":
        coef = lasso_cv_coefficients(df, label, col)
        idx = [i for i, v in enumerate(coef) if v != 0]
        if not idx:
            idx = _topk({i: abs(v) for i, v in enumerate(coef)}, k or 10, ascending_output=True)
        return Selection(method, idx, dict(enumerate(coef)))
    if method in ("random_forest", "rf_importance"):
        if k is None:
            raise ValueError("random_forest selection needs k")
        imp = rf_importances(df, label, col, trees=kw.get("trees", 100), regression=(method == "rf_importance"))
        s = dict(enumerate(imp))
        return Selection(method, _topk(s, k, ascending_output=True), s)
    if method == "logistic_regression":
        if k is None:
            raise ValueError("logistic_regression selection needs k")
        s = dict(enumerate(logistic_first_row(df, label, col)))
        return Selection(method, _topk(s, k, ascending_output=True), s)
    if method == "pca":
        proj, centre, ev = fit_pca(df, col, k or 10)
        return Selection(method, None, dict(enumerate(ev)), proj, centre)
    raise AssertionError(method)


def apply_select(df: DataFrame, sel: Selection, col: str = "features") -> DataFrame:
    """project new rows with a fitted selection."""
    if sel.projection is not None:
        return df.withColumn(col, pca_project(col, sel.projection, sel.centre))
    if sel.indices is None:
        return df
    return df.withColumn(col, pick(F.col(col), sel.indices))
