"""Training preparation and inference transform as one fitted state.

``fit`` runs a few aggregate jobs (impute stats, categories, optional
selection) and returns ``PrepState``; ``transform`` is a lazy, narrow
projection (plus alignment) that any number of new rows can stream through.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.missing import number
from tessera.operators import encode, impute, schema


@dataclass
class PrepConfig:
    target: str = "sii"
    keys: tuple = ("id",)
    imp: str = "median"              # median | mean | knn
    fts: str | None = None           # feature selection method (see operators.select)
    k_best: int | None = None
    imb: str | None = None           # smote | random_over | random_under | class_weight
    drop_missing_target: bool = True
    correlation_threshold: float = 0.9
    target_corr_threshold: float = 0.05
    seed: int = 42
    max_categories: int = 10_000     # beyond it a column's categories stay a table and vectors are sparse


@dataclass
class PrepState:
    config: dict
    train_features: list = field(default_factory=list)  # input columns, training order
    num: list = field(default_factory=list)
    cat: list = field(default_factory=list)
    types: dict = field(default_factory=dict)
    num_fill: dict = field(default_factory=dict)
    cat_fill: dict = field(default_factory=dict)
    dropped: list = field(default_factory=list)
    mean: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)
    tables: dict = field(default_factory=dict)           # columns with more than max_categories: CategoryTable as a dict
    feature_names: list = field(default_factory=list)    # after the column transformer
    selected: list | None = None                          # indices into feature_names
    selected_names: list | None = None
    projection: list | None = None                        # PCA loadings (rows = components)
    centre: list | None = None
    num_classes: int | None = None
    knn_donors: str | None = None        # imp='knn': training rows (key + numerics) in the shared folder
    knn_means: dict | None = None

    @property
    def width(self) -> int:
        """Features after the column transformer."""
        return len(self.num) + sum(self.tables[c]["n"] if c in self.tables else len(self.categories[c]) for c in self.cat)

    def offsets(self) -> dict:
        """The first one-hot position of each categorical column."""
        out, at = {}, len(self.num)
        for c in self.cat:
            out[c] = at
            at += self.tables[c]["n"] if c in self.tables else len(self.categories[c])
        return out

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> "PrepState":
        return PrepState(**json.loads(s))


def _imputed_moments(df: DataFrame, cols, strategy: str, cat_cols=(), cat_limit: int = 0,
                     cat_out: dict | None = None, **kw):
    """Fill values and the mean / population std of the *imputed* columns.

    The scaler is fitted after imputation; with a constant fill f the
    imputed moments follow from (rows N, present k, mean m, var v) of the
    raw column, so one aggregate pass serves both steps (parallel-variance
    combination, numerically stable)."""
    cols = list(cols)
    if not cols:
        if cat_cols and cat_out is not None:
            cat_out.update(impute.counts_if_few(df, list(cat_cols), cat_limit))
        return {}, [], {}, {}
    if strategy not in ("mean", "median"):
        raise ValueError(f"unsupported imputation method: {strategy}")
    extra = impute.bracket_aggs(cols, 0.5) if strategy == "median" else []
    row = df.agg(F.count(F.lit(1)).alias("N"), *[a for i, c in enumerate(cols) for a in (
        F.count(number(c)).alias(f"k{i}"), F.avg(number(c)).alias(f"m{i}"),
        F.var_pop(number(c)).alias(f"v{i}"))], *extra).first()
    if strategy == "mean":
        fills = {c: row[f"m{i}"] for i, c in enumerate(cols)}
        if cat_cols and cat_out is not None:
            cat_out.update(impute.counts_if_few(df, list(cat_cols), cat_limit))
    else:
        fills = impute.exact_quantiles(df, cols, 0.5, first=row, cat_cols=cat_cols, cat_limit=cat_limit,
                                       cat_out=cat_out, **kw)
    N = row["N"]
    mean, scale, dropped = {}, {}, []
    for i, c in enumerate(cols):
        k, m, v, f = row[f"k{i}"], row[f"m{i}"], row[f"v{i}"], fills.get(c)
        if not k or f is None:
            dropped.append(c)
            continue
        m2 = (k * m + (N - k) * f) / N
        var = (k * v + k * (m - m2) ** 2 + (N - k) * (f - m2) ** 2) / N
        sd = math.sqrt(max(var, 0.0))
        mean[c], scale[c] = m2, (sd if sd > 0 else 1.0)
    return {c: f for c, f in fills.items() if c not in dropped}, dropped, mean, scale


def _fit_categories(df: DataFrame, cfg: PrepConfig, st: PrepState, cat, vc: dict) -> list:
    """Modes and sorted categories; a column with more than ``max_categories`` keeps its categories as a table.
    ``vc``: value counts where they are known. Returns the columns without a value."""
    unknown = [c for c in cat if c not in vc or len(vc[c]) > cfg.max_categories]
    vc = {**vc, **encode.category_tables(df, unknown, cfg.max_categories)}
    st.tables = {c: asdict(vc[c]) for c in cat if isinstance(vc[c], encode.CategoryTable)}
    st.cat_fill = {c: st.tables[c]["mode"] if c in st.tables else min(vc[c].items(), key=lambda kv: (-kv[1], kv[0]))[0] for c in cat if c in st.tables or vc[c]}
    st.cat = [c for c in cat if c in st.cat_fill]
    st.categories = {c: sorted(vc[c]) for c in st.cat if c not in st.tables}
    return [c for c in cat if c not in st.cat_fill]


def _feature_names(st: PrepState) -> list:
    """Names of the features; those of a category table are read from it where they are wanted (``names_at``)."""
    return list(st.num) + [f"{c}_{v}" for c in st.cat for v in st.categories.get(c, ())]


def names_at(spark, st: PrepState, positions) -> list:
    """Names of the features at ``positions``."""
    if not st.tables:
        return [st.feature_names[i] for i in positions]
    found = dict(enumerate(st.num))
    for c, at in st.offsets().items():
        if c in st.tables:
            want = [i - at for i in positions if at <= i < at + st.tables[c]["n"]]
            rows = encode.CategoryTable(**st.tables[c]).frame(spark).where(F.col("idx").isin(want)).collect() if want else []
            found |= {at + r["idx"]: f"{c}_{r['v']}" for r in rows}
        else:
            found |= {at + i: f"{c}_{v}" for i, v in enumerate(st.categories[c])}
    return [found[i] for i in positions]


def fit(df: DataFrame, cfg: PrepConfig, found: dict | None = None) -> PrepState:
    """Fit imputers, scaler and one-hot categories (training preparation up
    to the column transformer). Selection is fitted by ``fit_select``.
    ``found`` gets the neighbours' values of the training rows (imp='knn')."""
    if cfg.drop_missing_target and cfg.target in df.columns:
        df = schema.drop_missing_target(df, cfg.target)
    num, cat = schema.feature_kinds(df, cfg.target, exclude=cfg.keys)
    df = impute.normalize_nan(df, num)
    st = PrepState(config=asdict(cfg))
    st.train_features = [c for c in df.columns if c != cfg.target and c not in cfg.keys]
    st.types = {c: df.schema[c].dataType.simpleString() for c in st.train_features}
    if cfg.imp == "knn":
        return _fit_knn(df, cfg, st, num, cat, {} if found is None else found)
    # value counts give both the mode (ties → smallest) and the sorted
    # category list (the fill is an existing value, so it adds none); with
    # median imputation they ride along in the exact-median histogram job
    vc = {}
    st.num_fill, dropped_n, st.mean, st.scale = _imputed_moments(
        df, num, cfg.imp, cat_cols=cat, cat_limit=cfg.max_categories * max(1, len(cat)), cat_out=vc)
    st.dropped = dropped_n + _fit_categories(df, cfg, st, cat, vc)
    st.num = [c for c in num if c not in dropped_n]
    st.feature_names = _feature_names(st)
    return st


def _fit_knn(df: DataFrame, cfg: PrepConfig, st: PrepState, num, cat, found: dict) -> PrepState:
    """imp='knn': the training rows are the donors. They are written once to
    the shared checkpoint folder (the state keeps the path), the scaler is
    fitted on the kNN-imputed training rows."""
    import uuid
    from tessera.operators.knn import filled, fills
    from tessera.session import ensure_checkpoint_dir
    key = cfg.keys[0]
    dropped_c = _fit_categories(df, cfg, st, cat, {})
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in num]).first() if num else {}
    dropped_n = [c for c in num if not row[c]]
    st.dropped = dropped_n + dropped_c
    st.num = [c for c in num if c not in dropped_n]
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/knn-donors-{uuid.uuid4().hex}"
    df.select(key, *st.num).write.mode("overwrite").parquet(path)
    st.knn_donors = path
    donors = df.sparkSession.read.parquet(path)
    m = donors.agg(*[F.avg(c).alias(c) for c in st.num]).first() if st.num else {}
    st.knn_means = {c: m[c] for c in st.num}
    if st.num:
        found["fills"], _ = fills(donors, key, st.num, means=st.knn_means)
    imputed = filled(donors, key, st.num, found["fills"], st.knn_means) if st.num else donors
    sc = imputed.agg(*[a for i, c in enumerate(st.num) for a in (
        F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))]).first() if st.num else {}
    for i, c in enumerate(st.num):
        st.mean[c] = sc[f"m{i}"]
        st.scale[c] = sc[f"s{i}"] or 1.0
        st.num_fill[c] = st.knn_means[c]      # only a fallback; rows are kNN-imputed first
    st.feature_names = _feature_names(st)
    return st


def knn_fill(df: DataFrame, st: PrepState, found: dict | None = None) -> DataFrame:
    """imp='knn': impute the numeric columns of ``df`` from the stored
    training donors (no-op for other strategies). ``found``: what ``fit``
    found for the training rows, when ``df`` is those."""
    if not st.knn_donors or not st.num:
        return df
    from tessera.operators.knn import filled, knn_impute
    key = st.config["keys"][0]
    if found:
        return filled(impute.normalize_nan(df, st.num), key, st.num, found["fills"], st.knn_means)
    donors = df.sparkSession.read.parquet(st.knn_donors)
    return knn_impute(impute.normalize_nan(df, st.num), key, st.num, donors=donors, means=st.knn_means)


def feature_exprs(st: PrepState):
    """D5 column transformer: [scaled numerics…, one-hots…] as expressions."""
    exprs = []
    for c in st.num:
        x = F.coalesce(number(c), F.lit(st.num_fill[c]))
        exprs.append((x - F.lit(st.mean[c])) / F.lit(st.scale[c]))
    for c in st.cat:
        x = F.coalesce(F.col(c).cast("string"), F.lit(st.cat_fill[c]))
        exprs += [F.when(x == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)) for v in st.categories[c]]
    return exprs


def features(df: DataFrame, st: PrepState, keep=(), out: str = "features") -> DataFrame:
    """Apply imputation + scaling + one-hot in one projection → array<double>.
    A state with category tables gives sparse vectors (see ``sparse_features``)."""
    if st.tables:
        return sparse_features(df, st, keep, out)
    ex = feature_exprs(st)
    arr = F.array(*ex) if ex else F.array().cast("array<double>")
    return df.select(*[F.col(k) for k in keep], arr.alias(out))


def sparse_features(df: DataFrame, st: PrepState, keep=(), out: str = "features") -> DataFrame:
    """The features as struct<size, indices, values>: the numerics at their positions and a 1 for each category.
    A category that is not known sets none."""
    keep, at = list(keep), st.offsets()
    value = {c: F.coalesce(F.col(c).cast("string"), F.lit(st.cat_fill[c])) for c in st.cat}
    code = {}
    for i, c in enumerate(st.cat):
        if c in st.tables:
            name = f"_slot{i}"
            df = encode.CategoryTable(**st.tables[c]).code(df, value[c], name)
            code[c] = F.col(name)
        else:
            code[c] = F.nullif(F.array_position(F.array(*[F.lit(v) for v in st.categories[c]]), value[c]), F.lit(0)) - 1
    num = [(F.coalesce(number(c), F.lit(st.num_fill[c])) - F.lit(st.mean[c])) / F.lit(st.scale[c]) for c in st.num]
    hot = F.filter(F.array(*[(code[c] + F.lit(at[c])).cast("int") for c in st.cat]), lambda i: i.isNotNull())
    indices = F.concat(F.array(*[F.lit(i) for i in range(len(num))]).cast("array<int>"), hot)
    values = F.concat(F.array(*num).cast("array<double>"), F.transform(hot, lambda i: F.lit(1.0)))
    return df.select(*[F.col(k) for k in keep], F.struct(F.lit(st.width).alias("size"), indices.alias("indices"), values.alias("values")).alias(out))


def _entry(col: str, i) -> Column:
    """The value of a sparse vector at a position."""
    return F.coalesce(F.element_at(F.map_from_arrays(F.col(f"{col}.indices"), F.col(f"{col}.values")), F.lit(i) if isinstance(i, int) else i), F.lit(0.0))


def densify(df: DataFrame, col: str = "features") -> DataFrame:
    """Sparse vectors as array<double>, for what reads all positions (selection, SMOTE)."""
    return df.withColumn(col, F.transform(F.sequence(F.lit(0), F.col(f"{col}.size") - 1), lambda i: _entry(col, i)))


def align(df: DataFrame, st: PrepState, keep=()) -> DataFrame:
    """B6 against the fitted schema."""
    return schema.align_columns(df, st.train_features, st.cat, st.types, keep=keep)


def explode_features(df: DataFrame, keys, names, col: str = "features") -> DataFrame:
    """Long form (keys…, fi, feature, value) for comparison and reporting."""
    nm = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    return (df.select(*keys, F.posexplode(col).alias("fi", "value"))
            .select(*keys, F.col("fi").cast("int").alias("fi"), F.element_at(nm, F.col("fi") + 1).alias("feature"),
                    F.round("value", 6).alias("value")))


def explode_sparse(df: DataFrame, keys, col: str = "features") -> DataFrame:
    """Long form (keys…, fi, value) of sparse vectors: the positions that are set."""
    return (df.select(*keys, F.explode(F.arrays_zip(f"{col}.indices", f"{col}.values")).alias("e"))
            .select(*keys, F.col("e.indices").alias("fi"), F.round("e.values", 6).alias("value")))


def fit_transform(df: DataFrame, cfg: PrepConfig, out: str = "features"):
    """Training preparation end to end: drop null target → fit imputers,
    scaler, one-hot → features → (optional) selection → (optional)
    rebalancing → (optional) class weights.

    Returns (DataFrame[keys…, target, features], PrepState, weights or None);
    the DataFrame is lazy and the state is driver-sized.
    """
    from tessera.operators import balance, select
    found: dict = {}
    st = fit(df, cfg, found)
    base = schema.drop_missing_target(df, cfg.target) if cfg.drop_missing_target else df
    x = features(knn_fill(base, st, found), st, keep=[*cfg.keys, cfg.target], out=out)
    if st.tables and (cfg.fts not in (None, "none") or cfg.imb == "smote"):
        x = densify(x, out)
    st.num_classes = schema.num_classes(base, cfg.target).first()[0] if cfg.target in base.columns else None
    if cfg.fts and cfg.fts != "none":
        kw = {}
        if cfg.fts == "correlation_threshold":
            kw = dict(threshold=cfg.correlation_threshold, target_threshold=cfg.target_corr_threshold)
        sel = select.fit_select(x, cfg.fts, cfg.target, out, k=cfg.k_best, **kw)
        x = select.apply_select(x, sel, out)
        st.selected, st.projection, st.centre = sel.indices, sel.projection, sel.centre
        st.selected_names = (names_at(df.sparkSession, st, sel.indices) if sel.indices is not None
                             else [f"PC{i + 1}" for i in range(len(sel.projection or []))])
    key = cfg.keys[0] if len(cfg.keys) == 1 else list(cfg.keys)
    weights = None
    if cfg.imb == "random_under":
        x = balance.random_under(x, cfg.target, key, cfg.seed)
    elif cfg.imb == "random_over":
        x = balance.random_over(x, cfg.target, key, cfg.seed)
    elif cfg.imb == "smote":
        from tessera.operators.knn import smote
        x = smote(x, cfg.target, key, out, seed=cfg.seed)
    elif cfg.imb == "class_weight":
        weights = balance.class_weights(x, cfg.target)
    elif cfg.imb not in (None, "none"):
        raise ValueError(f"unknown balancing strategy: {cfg.imb}")
    return x, st, weights


def transform(df: DataFrame, st: PrepState, out: str = "features", keep=()) -> DataFrame:
    """Inference: align to the training schema, apply the fitted state and
    the fitted selection; one narrow projection, no job at call time.
    ``keep``: further columns that ride along (a label to compare with)."""
    from tessera.functions.arrays import pick
    keys = [*st.config["keys"], *keep]
    x = features(knn_fill(align(df, st, keep=keys), st), st, keep=keys, out=out)
    if st.projection is not None:
        from tessera.operators.select import pca_project
        x = (densify(x, out) if st.tables else x).withColumn(out, pca_project(out, st.projection, st.centre))
    elif st.selected is not None:
        x = x.withColumn(out, F.array(*[_entry(out, i) for i in st.selected]) if st.tables else pick(F.col(out), st.selected))
    return x


def save_state(spark, st: PrepState, path: str) -> None:
    """Persist the fitted state as a one-row JSON table (no pickle)."""
    spark.createDataFrame([(st.to_json(),)], "state string").coalesce(1).write.mode("overwrite").json(path)


def load_state(spark, path: str) -> PrepState:
    return PrepState.from_json(spark.read.json(path).first()["state"])


def output_width(st: PrepState) -> int:
    """Width of ``transform``'s feature vector under this state."""
    if st.projection is not None:
        return len(st.projection)
    return len(st.selected) if st.selected is not None else st.width


def check_width(st: PrepState, model_input: int) -> None:
    """Refuse to score when the model was trained on another feature width
    (e.g. a different selection method or k)."""
    w = output_width(st)
    if w != model_input:
        raise ValueError(f"transformed width {w} != model input {model_input}; "
                         "check the selection method and k used at training")


def predict_new(df: DataFrame, st: PrepState, layers, id_col: str | None = None) -> DataFrame:
    """Inference end to end: align → fitted transform → selection → width
    check → scores → (id, prediction, probability). ``layers``: an MLP's
    [(W, b), …] or a highway network (a dict, see ``score_highway``)."""
    from tessera.operators import score
    highway = isinstance(layers, dict)
    first = (layers["proj"] or layers["layers"][0]) if highway else layers[0]
    check_width(st, len(first[0][0]))
    keys = list(st.config["keys"])
    x = transform(df, st)
    out = (score.score_highway if highway else score.score_mlp)(x, layers, col="features", keep=keys)
    return out.select(F.col(id_col or keys[0]).alias("id"), "prediction", "probability")
