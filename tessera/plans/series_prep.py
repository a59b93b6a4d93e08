"""Series samples: static vector per subject + fixed-length sequence + label.

One set-based plan for all subjects (or a given id list): the series is
scanned once, filled/cut per subject by the chunked scan of
``operators.series``, collected into bounded sequences (≤ tail steps) and
joined to the static vector. No per-subject loop, no file per subject.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.missing import number
from tessera.operators import encode, impute, schema, series
from tessera.session import written


@dataclass
class SeriesState:
    id_col: str = "id"
    target: str = "sii"
    num: list = field(default_factory=list)
    cat: list = field(default_factory=list)
    fills: dict = field(default_factory=dict)
    mean: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)
    classes: dict = field(default_factory=dict)
    tables: dict = field(default_factory=dict)       # columns with very many classes: CategoryTable as a dict
    selection: str = "none"
    projection: list | None = None      # PCA: PC loadings over the filled numerics
    centre: list | None = None
    num_source: list = field(default_factory=list)   # PCA: filled numerics feeding the components

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> "SeriesState":
        return SeriesState(**json.loads(s))


def save_state(spark, st: SeriesState, path: str) -> None:
    """The fitted state as a one-row JSON table (no pickle)."""
    spark.createDataFrame([(st.to_json(),)], "state string").coalesce(1).write.mode("overwrite").json(path)


def load_state(spark, path: str) -> SeriesState:
    return SeriesState.from_json(spark.read.json(path).first()["state"])


def fit_static(static: DataFrame, id_col: str = "id", target: str = "sii", columns=None,
               feature_selection: str = "none", n_features: int = 10, max_categories: int = 10_000) -> SeriesState:
    """Fit on labelled subjects: numeric mean fill → (optional selection over
    the filled numerics: ``mutual_info``, ``lasso`` (CV), ``rf_importance``,
    ``pca`` → PC1…) → standardize; strings filled with 'Unknown' → sorted
    label codes (series kind policy: other types are ignored). ``columns``
    restricts to e.g. common static columns; a column with more than
    ``max_categories`` classes keeps them as a table."""
    df = schema.drop_missing_target(static, target)
    if columns is not None:
        df = df.select(id_col, target, *[c for c in columns if c in df.columns])
    num, cat = schema.feature_kinds(df, target, exclude=[id_col], policy="series")
    df = impute.normalize_nan(df, num)
    st = SeriesState(id_col, target, num, cat)
    # one pass: mean fill and the moments of the filled columns (the scaler
    # is fitted after filling); one pass: categories of the filled strings
    from tessera.plans.prep import _imputed_moments
    st.fills, dropped, st.mean, st.scale = _imputed_moments(df, num, "mean")
    st.num = [c for c in num if c not in dropped]
    if feature_selection not in ("none", None) and st.num:
        _select_static(df, st, feature_selection, n_features)
    filled = impute.fill_unknown(df.select(*cat), cat)
    classes = encode.fit_label_encode(filled, cat, max_categories)
    st.tables = {c: asdict(v) for c, v in classes.items() if isinstance(v, encode.CategoryTable)}
    st.classes = {c: v for c, v in classes.items() if c not in st.tables}
    return st


def _filled_numeric(st: SeriesState, cols):
    return F.array(*[F.coalesce(number(c), F.lit(st.fills[c])) for c in cols])


def _select_static(df: DataFrame, st: SeriesState, method: str, n: int) -> None:
    """Selection over the mean-filled numeric static columns."""
    from tessera.operators import select
    x = df.select(_filled_numeric(st, st.num).alias("features"), F.col(st.target))
    meth = {"mutual_info": "mutual_info", "lasso": "lasso_cv", "rf_importance": "rf_importance",
            "pca": "pca"}.get(method)
    if meth is None:
        raise ValueError(f"unknown feature selection method: {method}")
    sel = select.fit_select(x, meth, st.target, k=min(n, len(st.num)) if meth != "lasso_cv" else n)
    st.selection = method
    if sel.projection is not None:
        st.projection, st.centre = sel.projection, sel.centre
        pcs = select.pca_project("features", sel.projection, sel.centre)
        names = [f"PC{i + 1}" for i in range(len(sel.projection))]
        pc = x.select(*[pcs.getItem(i).alias(nm) for i, nm in enumerate(names)])
        from tessera.operators import encode
        sc = encode.fit_scale(pc, names)
        st.mean.update(sc.mean)
        st.scale.update(sc.scale)
        st.num_source, st.num = list(st.num), names
    else:
        st.num = [st.num[i] for i in sel.indices]


def static_vector(df: DataFrame, st: SeriesState, keep=None, unseen: str = "keep", out: str = "static") -> DataFrame:
    """[scaled numerics…, label codes…] as array<double>."""
    ex = []
    if st.projection is not None:
        from tessera.operators.select import pca_project
        df = df.withColumn("_pcin", _filled_numeric(st, st.num_source)) \
               .withColumn("_pcs", pca_project("_pcin", st.projection, st.centre))
        for i, c in enumerate(st.num):
            ex.append((F.col("_pcs").getItem(i) - F.lit(st.mean[c])) / F.lit(st.scale[c]))
    for c in ([] if st.projection is not None else st.num):
        x = F.coalesce(number(c), F.lit(st.fills[c]))
        ex.append((x - F.lit(st.mean[c])) / F.lit(st.scale[c]))
    for c in st.cat:
        x = F.coalesce(F.col(c).cast("string"), F.lit("Unknown"))
        if c in st.tables:
            df = encode.CategoryTable(**st.tables[c]).code(df, x, f"_code_{c}")
            ex.append(encode.table_code(c, f"_code_{c}", unseen, x))
            continue
        idx = (F.array_position(F.array(*[F.lit(v) for v in st.classes[c]]), x) - 1).cast("double")
        if unseen == "error":
            idx = F.when(idx < 0, F.raise_error(F.lit(f"unseen label in {c}"))).otherwise(idx)
        ex.append(idx)
    keep = [st.id_col] if keep is None else list(keep)
    return df.select(*keep, F.array(*ex).alias(out))


def sequences(series_df: DataFrame, id_col: str, order, every: int = 10, tail: int = 1000,
              cols=None) -> DataFrame:
    """H2, H4-H7: fill → every n-th → last ``tail`` → numeric → nested array."""
    order = [order] if isinstance(order, str) else list(order)
    cols = cols or series.numeric_columns(series_df, exclude=[id_col])
    f = series.fill_series(series_df, id_col, order, cols, every=every, tail=tail)
    return series.build_sequences(f.select(id_col, *order, *cols), id_col, order, cols)


def assemble(static: DataFrame, series_df: DataFrame, st: SeriesState, order, every: int = 10,
             tail: int = 1000, labelled: bool = True, ids: DataFrame | None = None) -> DataFrame:
    """B7 + B8 + H8: subjects that have a series, their static
    vector, sequence and (when ``labelled``) label. ``ids`` optionally
    restricts to a list of subjects (one pruned scan, no per-id loop)."""
    s = schema.drop_missing_target(static, st.target) if labelled else static
    if ids is not None:
        s = s.join(ids.select(st.id_col), st.id_col, "left_semi")
        series_df = series_df.join(ids.select(st.id_col), st.id_col, "left_semi")
    # the inner join with the sequences keeps only subjects that have a series
    keep = [st.id_col] + ([st.target] if labelled else [])
    sv = static_vector(s, st, keep=keep)
    seq = sequences(series_df, st.id_col, order, every, tail)
    return schema.assemble_samples(sv, seq, st.id_col)


def series_datasets(static: DataFrame, series_df: DataFrame, order, split: str = "both", test_size: float = 0.2,
                    batch_size: int = 8, every: int = 10, tail: int = 1000, id_col: str = "id",
                    target: str = "sii", seed=42, columns=None, feature_selection: str = "none",
                    n_features: int = 10):
    """Series loaders as one plan: labelled subjects split (stratified on the
    target) → subjects without a series dropped → state fitted on the
    training subjects → samples → padded batches (training batches in keyed
    shuffled order, validation batches in id order).

    Returns {split name: DataFrame(id, target, batch_id, n_steps, padded,
    static)} for 'train', 'val' or both, plus the fitted state."""
    from tessera.operators import balance, series as ser
    if split not in ("train", "val", "both"):
        raise ValueError("split must be 'train', 'val' or 'both'")
    lab = schema.drop_missing_target(static, target)
    parts = balance.stratified_split(lab, target, id_col, test_size, seed)
    st = fit_static(parts.where(F.col("split") == "train").drop("split"), id_col, target, columns,
                    feature_selection, n_features)
    want = ["train", "val"] if split == "both" else [split]
    # the series is read once for both loaders: samples with their split, written, then batched per split
    chosen = parts.where(F.col("split").isin(want)).select(id_col, "split")
    samples = written(assemble(static, series_df, st, order, every, tail, labelled=True, ids=chosen).join(chosen, id_col), "samples")
    out = {name: ser.pad_batches(samples.where(F.col("split") == name).drop("split"), id_col, "seq", batch_size,
                                 shuffle=(name == "train"), seed=seed) for name in want}
    return out, st


def predict_series(static: DataFrame, series_df: DataFrame, st: SeriesState, net: dict, order, every: int = 10,
                   tail: int = 1000, ids: DataFrame | None = None) -> DataFrame:
    """Series inference as one plan: prepared samples → hybrid scores → one
    prediction for each requested id (default: every row of ``static``), −1
    where there is no series."""
    from tessera.operators import score
    want = static.select(st.id_col) if ids is None else ids.select(st.id_col)
    scored = score.score_hybrid(assemble(static, series_df, st, order, every, tail, labelled=False, ids=ids), net, keep=(st.id_col,))
    return schema.predictions_for(want, scored, st.id_col)
