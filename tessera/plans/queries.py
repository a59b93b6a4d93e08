"""Registered queries: one per operator of SURVEY §2 that the driver runs.

Each takes (spark, sf_dir) and returns a DataFrame over the whole given
tables. Names match ``tessera.plans.oracles.ORACLES``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import prep
from tessera.sources import fixtures as fx
from tessera.operators import series as ser
from tessera.operators import schema as sch
from tessera.operators import balance as bal
from tessera.operators import metrics as met
from tessera.plans import series_prep as sp
from tessera.operators import impute as imp
from tessera.operators import encode as enc
from tessera.operators import select as fsel
from tessera.operators import score as sco
from tessera.operators import knn
from tessera.sources import io
from tessera.plans import tabular

QUERIES: dict = {}


def query(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


TAB_KEYS = ("o_orderkey",)


def _tab_cfg(imp="median", **kw):
    return prep.PrepConfig(target="y", keys=TAB_KEYS, imp=imp, **kw)


def _prep_long(spark, sf, imp):
    t = fx.tab(spark, sf)
    st = prep.fit(t, _tab_cfg(imp))
    lab = t.where(F.col("y").isNotNull())
    return prep.explode_features(prep.features(lab, st, keep=TAB_KEYS), TAB_KEYS, st.feature_names)


@query("d5_prep_train_median")
def d5_prep_train_median(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: drop null target → median/most-frequent impute → standardize
    → one-hot → feature matrix (long form)."""
    return _prep_long(spark, sf, "median")


@query("c2_prep_train_mean")
def c2_prep_train_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _prep_long(spark, sf, "mean")


TAB_NUM = ("o_totalprice", "c_acctbal")


@query("d5_prep_train_nan")
def d5_prep_train_nan(spark, sf):
    """NaN instead of null in the numeric columns: the same features."""
    t = fx.with_nan(fx.tab(spark, sf), *TAB_NUM)
    st = prep.fit(t, _tab_cfg("median"))
    return prep.explode_features(prep.features(t.where(F.col("y").isNotNull()), st, keep=TAB_KEYS), TAB_KEYS, st.feature_names)


@query("c6_all_missing_dropped")
def c6_all_missing_dropped(spark, sf):
    """Columns without any value (null, NaN, no text) leave no feature."""
    t = fx.tab(spark, sf).withColumns({"gone": F.lit(None).cast("double"), "gone_nan": F.lit(float("nan")), "gone_text": F.lit(None).cast("string")})
    st = prep.fit(t, _tab_cfg("median"))
    return prep.explode_features(prep.features(t.where(F.col("y").isNotNull()), st, keep=TAB_KEYS), TAB_KEYS, st.feature_names)


@query("a6_state_roundtrip")
def a6_state_roundtrip(spark, sf):
    """A fitted state saved, loaded and applied to new rows."""
    import uuid
    from tessera.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark)}/state-{uuid.uuid4().hex}"
    prep.save_state(spark, prep.fit(fx.tab(spark, sf), _tab_cfg("median")), path)
    st = prep.load_state(spark, path)
    new = prep.align(fx.tab_new(spark, sf), st, keep=TAB_KEYS)
    return prep.explode_features(prep.features(new, st, keep=TAB_KEYS), TAB_KEYS, st.feature_names)


@query("a6_pipeline_model")
def a6_pipeline_model(spark, sf):
    """The preparation as a stage of a ``pyspark.ml`` pipeline, saved, loaded and applied to new rows."""
    import uuid
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.functions import vector_to_array
    from tessera.plans.ml import TabularPrep
    from tessera.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    Pipeline(stages=[TabularPrep(_tab_cfg("median"))]).fit(fx.tab(spark, sf)).write().save(path)
    model = PipelineModel.load(path)
    got = model.transform(fx.tab_new(spark, sf)).withColumn("features", vector_to_array("features"))
    return prep.explode_features(got, TAB_KEYS, model.stages[0].state.feature_names)


# ---------------------------------------------------------------- series (H)

SER_ORDER = ("ts", "event_id")
SER_COLS = ("event_id", "value", "k")   # numeric columns of the series view
EVERY, TAIL = 10, 5


def _ser_out(df):
    return df.select("id", "event_id", F.round("value", 6).alias("value"), F.round("k", 6).alias("k"))


@query("h1_ffill")
def h1_ffill(spark, sf):
    s = fx.series(spark, sf)
    return _ser_out(ser.ffill(s, "id", SER_ORDER, ["value", "k"]))


@query("h2_fill_chain")
def h2_fill_chain(spark, sf):
    s = fx.series(spark, sf)
    return _ser_out(ser.fill_series(s, "id", SER_ORDER, ["value", "k"]))


@query("h3_ffill_zero")
def h3_ffill_zero(spark, sf):
    s = fx.series(spark, sf)
    return _ser_out(ser.fill_series(s, "id", SER_ORDER, ["value", "k"], bfill=False))


@query("h4_downsample")
def h4_downsample(spark, sf):
    s = fx.series(spark, sf)
    return _ser_out(ser.fill_series(s, "id", SER_ORDER, ["value", "k"], every=EVERY))


@query("h5_tail")
def h5_tail(spark, sf):
    s = fx.series(spark, sf)
    return _ser_out(ser.fill_series(s, "id", SER_ORDER, ["value", "k"], every=EVERY, tail=TAIL))


@query("a3_series_clustered")
def a3_series_clustered(spark, sf):
    """The series written as a clustered table in the shared folder; fill, down-sampling and tail on it, rows as they lie."""
    import uuid
    from tessera.session import ensure_checkpoint_dir
    name = f"series_{uuid.uuid4().hex}"
    ser.write_clustered(fx.series(spark, sf), name, "id", SER_ORDER, f"{ensure_checkpoint_dir(spark)}/{name}")
    return _ser_out(ser.fill_series(spark.table(name), "id", SER_ORDER, ["value", "k"], every=EVERY, tail=TAIL))


SER_KEEP = ("id", "ts", "event_id", "event_type")


@query("h2_fill_keep_columns")
def h2_fill_keep_columns(spark, sf):
    """The fill chain with a column that the summary does not need."""
    s = ser.fill_series(fx.series(spark, sf), "id", SER_ORDER, ["value", "k"])
    return s.select("id", "event_id", "event_type", F.round("value", 6).alias("value"), F.round("k", 6).alias("k"))


@query("h4_downsample_rows")
def h4_downsample_rows(spark, sf):
    return ser.downsample(fx.series(spark, sf).select(*SER_KEEP), "id", SER_ORDER, n=EVERY).select("id", "event_id", "event_type")


@query("h5_tail_rows")
def h5_tail_rows(spark, sf):
    return ser.tail(fx.series(spark, sf).select(*SER_KEEP), "id", SER_ORDER, n=TAIL).select("id", "event_id", "event_type")


def _sequences(spark, sf):
    s = fx.series(spark, sf)
    cols = ser.numeric_columns(s, exclude=["id"])            # H6: event_id, value, k
    filled = ser.fill_series(s, "id", SER_ORDER, cols, every=EVERY, tail=TAIL)
    return ser.build_sequences(filled.select("id", *SER_ORDER, *cols), "id", SER_ORDER, cols)


@query("h7_sequences")
def h7_sequences(spark, sf):
    return ser.explode_sequences(_sequences(spark, sf), "id")


@query("b9_pad_batches")
def b9_pad_batches(spark, sf):
    p = ser.pad_batches(_sequences(spark, sf), "id", "seq", batch_size=8, shuffle=True, seed=42)
    pad_sum = F.aggregate(F.flatten("padded"), F.lit(0.0), lambda a, x: a + x)
    return p.select("id", "batch_id", F.col("n_steps").cast("int").alias("n_steps"),
                    F.size("padded").cast("int").alias("padded_steps"), F.round(pad_sum, 6).alias("pad_sum"))


@query("b9_batches_in_order")
def b9_batches_in_order(spark, sf):
    p = ser.pad_batches(_sequences(spark, sf), "id", "seq", batch_size=8, shuffle=False)
    return p.select("id", "batch_id", F.size("padded").cast("int").alias("padded_steps"))


# ------------------------------------------------------- balance & split (G)


def _docs(spark, sf):
    return sch.drop_missing_target(fx.doc_lab(spark, sf), "quality")


@query("b1_drop_missing_target")
def b1_drop_missing_target(spark, sf):
    return _docs(spark, sf).select("doc_id", "quality")


@query("b11_class_counts")
def b11_class_counts(spark, sf):
    s = bal.stratified_split(_docs(spark, sf), "quality", "doc_id", 0.2, 42)
    return sch.class_counts(s, "quality", by=["split"]).select("split", "quality", F.col("n").cast("bigint"))


@query("b12_num_classes")
def b12_num_classes(spark, sf):
    return sch.num_classes(fx.tab(spark, sf), "y").select(F.col("num_classes").cast("bigint"))


@query("g1_class_weights")
def g1_class_weights(spark, sf):
    return bal.class_weights(_docs(spark, sf), "quality").select(
        "quality", F.col("n_c").cast("bigint"), F.round("weight", 6).alias("weight"))


@query("g2_random_over")
def g2_random_over(spark, sf):
    return bal.random_over(_docs(spark, sf).select("doc_id", "quality"), "quality", "doc_id", 42)


@query("g3_random_under")
def g3_random_under(spark, sf):
    return bal.random_under(_docs(spark, sf).select("doc_id", "quality"), "quality", "doc_id", 42)


@query("g6_stratified_split")
def g6_stratified_split(spark, sf):
    return bal.stratified_split(fx.tab(spark, sf).select("o_orderkey", "y"), "y", "o_orderkey", 0.2, 42)


@query("g7_split_val")
def g7_split_val(spark, sf):
    s = bal.stratified_split(_docs(spark, sf).select("doc_id", "quality"), "quality", "doc_id", 0.2, 42)
    return bal.take_split(s, "val").select("doc_id", "quality")


@query("g8_random_split")
def g8_random_split(spark, sf):
    return bal.random_split(fx.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.8, 42)


# ------------------------------------------------------------- metrics (M)
def _pred(spark, sf):
    return fx.pred_logits(fx.pred(spark, sf))


def _r6(df):
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


@query("m1_confusion")
def m1_confusion(spark, sf):
    return met.confusion(fx.pred(spark, sf)).select("y", "yhat", F.col("n").cast("bigint"))


@query("m2_m6_scores")
def m2_m6_scores(spark, sf):
    return _r6(met.scores(met.confusion(fx.pred(spark, sf))))


@query("m7_cross_entropy")
def m7_cross_entropy(spark, sf):
    return _r6(met.cross_entropy(_pred(spark, sf), n_classes=3))


@query("m7_weighted_cross_entropy")
def m7_weighted_cross_entropy(spark, sf):
    p = bal.with_class_weights(_pred(spark, sf), "y")
    return _r6(met.cross_entropy(p, weight="weight", n_classes=3))


@query("m8_batch_mean_loss")
def m8_batch_mean_loss(spark, sf):
    return _r6(met.cross_entropy(_pred(spark, sf), batch="batch", n_classes=3))


@query("m9_report")
def m9_report(spark, sf):
    return _r6(met.report(_pred(spark, sf), batch="batch", n_classes=3))


# ------------------------------------------------- subjects & samples (B, D6)


def _subj_state(spark, sf):
    return sp.fit_static(fx.subjects(spark, sf), "id", "sii")


def _arr_sum(c):
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)


@query("d6_static_vector")
def d6_static_vector(spark, sf):
    subj = fx.subjects(spark, sf)
    st = _subj_state(spark, sf)
    v = sp.static_vector(sch.drop_missing_target(subj, "sii"), st)
    return (v.select("id", F.posexplode("static").alias("fi", "value"))
            .select("id", F.col("fi").cast("int").alias("fi"), F.round("value", 6).alias("value")))


@query("d6_static_vector_nan")
def d6_static_vector_nan(spark, sf):
    """NaN instead of null, and the state saved and loaded in between."""
    import uuid
    from tessera.session import ensure_checkpoint_dir
    subj = fx.with_nan(fx.subjects(spark, sf), "c_acctbal")
    path = f"{ensure_checkpoint_dir(spark)}/series-state-{uuid.uuid4().hex}"
    sp.save_state(spark, sp.fit_static(subj, "id", "sii"), path)
    v = sp.static_vector(sch.drop_missing_target(subj, "sii"), sp.load_state(spark, path))
    return (v.select("id", F.posexplode("static").alias("fi", "value"))
            .select("id", F.col("fi").cast("int").alias("fi"), F.round("value", 6).alias("value")))


@query("d3_onehot_sparse")
def d3_onehot_sparse(spark, sf):
    """One-hot of a column with a category for each row, beside a narrow one."""
    from tessera.operators import encode as enc
    c = fx.table(spark, sf, "customer")
    cols = ["c_name", "c_mktsegment"]
    index = enc.category_index(c.where(F.col("c_custkey") % 4 != 0), cols)        # a quarter of the names is unseen
    return enc.onehot_sparse(c, "c_custkey", cols, index).select("c_custkey", F.concat_ws(",", F.transform("slots", lambda x: x.cast("string"))).alias("slots"))


def _lines(spark, sf):
    """Line items with a key that nearly each has of its own as a categorical column, a fifth of it missing."""
    name = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey")
    return fx.table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.col("l_quantity").cast("double").alias("l_quantity"), "l_returnflag",
        F.when(F.col("l_orderkey") % 5 != 0, name).alias("part"), (F.col("l_linenumber") % 3).cast("int").alias("sii"))


@query("d5_prep_many_categories")
def d5_prep_many_categories(spark, sf):
    """Column transformer over tens of thousands of categories: sparse vectors, a category table in the state."""
    x, _, _ = prep.fit_transform(_lines(spark, sf), prep.PrepConfig(target="sii", keys=("id",), imp="mean", max_categories=100))
    return prep.explode_sparse(x, ["id"])


@query("d6_static_vector_many")
def d6_static_vector_many(spark, sf):
    """Static vectors with label codes of tens of thousands of classes."""
    df = _lines(spark, sf)
    v = sp.static_vector(df, sp.fit_static(df, "id", "sii", max_categories=100))
    return v.select("id", F.posexplode("static").alias("fi", "value")).select("id", F.col("fi").cast("int").alias("fi"), F.round("value", 6).alias("value"))


@query("a4_missing_ids")
def a4_missing_ids(spark, sf):
    """Subjects of the static table that have no series row."""
    return io.missing_ids(fx.series(spark, sf), "id", fx.subjects(spark, sf))


@query("a2_csv_string_key")
def a2_csv_string_key(spark, sf):
    """A CSV with zero-padded keys, its other columns inferred, read back."""
    import uuid
    from tessera.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark)}/customer-{uuid.uuid4().hex}"
    c = fx.table(spark, sf, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("id"), "c_nationkey", "c_acctbal")
    c.write.option("header", True).csv(path)
    back = io.read_table(spark, path, fmt="csv", string_cols=["id"])
    return back.select("id", F.col("c_nationkey").cast("int").alias("c_nationkey"), F.round("c_acctbal", 6).alias("c_acctbal"))


@query("b7_restrict_to_available")
def b7_restrict_to_available(spark, sf):
    subj = sch.drop_missing_target(fx.subjects(spark, sf), "sii")
    return sch.restrict_to_available(subj, fx.series(spark, sf)).select("id", "sii")


def _samples_out(df, labelled=True):
    seq_sum = _arr_sum(F.flatten("seq"))
    return df.select("id", *(["sii"] if labelled else []), F.size("seq").cast("int").alias("n_steps"),
                     F.round(seq_sum, 6).alias("seq_sum"), F.round(_arr_sum(F.col("static")), 6).alias("static_sum"))


@query("b8_assemble_samples")
def b8_assemble_samples(spark, sf):
    st = _subj_state(spark, sf)
    s = sp.assemble(fx.subjects(spark, sf), fx.series(spark, sf), st, SER_ORDER, EVERY, TAIL)
    return _samples_out(s)


@query("h8_prepare_inference")
def h8_prepare_inference(spark, sf):
    """Inference preparation for every subject with a series, using the state
    fitted on labelled subjects (no refit on new data)."""
    st = _subj_state(spark, sf)
    s = sp.assemble(fx.subjects(spark, sf), fx.series(spark, sf), st, SER_ORDER, EVERY, TAIL, labelled=False)
    return _samples_out(s, labelled=False)


@query("b2_common_columns")
def b2_common_columns(spark, sf):
    t, n = fx.tab(spark, sf), fx.tab_new(spark, sf)
    return sch.select_common(t, n, target="y")


@query("b3_common_static_columns")
def b3_common_static_columns(spark, sf):
    t, n = fx.tab(spark, sf), fx.tab_new(spark, sf)
    cols = sch.common_columns(t, n, target="y", exclude=["y", "o_orderkey"])
    return t.select("o_orderkey", *cols)


@query("b4_drop_columns")
def b4_drop_columns(spark, sf):
    return sch.drop_columns(fx.tab(spark, sf), "o_orderkey", "not_there", "c_acctbal")


@query("b6_align_columns")
def b6_align_columns(spark, sf):
    t = fx.tab(spark, sf)
    num, cat = sch.feature_kinds(t, "y", exclude=["o_orderkey"])
    cols = [c for c in t.columns if c not in ("y", "o_orderkey")]
    types = {c: t.schema[c].dataType.simpleString() for c in cols}
    return sch.align_columns(fx.tab_new(spark, sf), cols, cat, types, keep=["o_orderkey"])


@query("d5_transform_new_rows")
def d5_transform_new_rows(spark, sf):
    """Inference: align new rows to the training schema, apply the fitted
    imputers/scaler/one-hot (missing categorical '0' encodes to zeros)."""
    st = prep.fit(fx.tab(spark, sf), _tab_cfg("median"))
    new = prep.align(fx.tab_new(spark, sf), st, keep=TAB_KEYS)
    return prep.explode_features(prep.features(new, st, keep=TAB_KEYS), TAB_KEYS, st.feature_names)


# ----------------------------------------------- impute & encode steps (C, D)


@query("c1_median_impute")
def c1_median_impute(spark, sf):
    t = fx.tab(spark, sf)
    st = imp.fit_impute(t, ["o_totalprice", "c_acctbal"], "median")
    out = imp.apply_impute(t.select("o_orderkey", "o_totalprice", "c_acctbal"), st)
    return out.select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"),
                      F.round("c_acctbal", 6).alias("c_acctbal"))


@query("c4_most_frequent_impute")
def c4_most_frequent_impute(spark, sf):
    t = fx.tab(spark, sf)
    st = imp.fit_impute(t, ["o_orderstatus", "c_mktsegment"], "most_frequent")
    return imp.apply_impute(t.select("o_orderkey", "o_orderstatus", "c_mktsegment"), st)


@query("c5_fill_unknown")
def c5_fill_unknown(spark, sf):
    return imp.fill_unknown(fx.subjects(spark, sf).select("id", "c_mktsegment"), ["c_mktsegment"])


@query("d1_standardize")
def d1_standardize(spark, sf):
    t = fx.tab(spark, sf).select("o_orderkey", "o_totalprice", "c_acctbal")
    st = enc.fit_scale(t, ["o_totalprice", "c_acctbal"])
    out = enc.apply_scale(t, st)
    return out.select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"),
                      F.round("c_acctbal", 6).alias("c_acctbal"))


@query("d3_onehot")
def d3_onehot(spark, sf):
    t = fx.tab(spark, sf)
    cats = enc.fit_categories(t, ["o_orderstatus", "c_mktsegment"])
    ex = [e for c in ["o_orderstatus", "c_mktsegment"] for e in enc.onehot_exprs(c, cats[c])]
    names = [f"{c}_{v}" for c in ["o_orderstatus", "c_mktsegment"] for v in cats[c]]
    w = t.select("o_orderkey", F.array(*ex).alias("features"))
    return prep.explode_features(w, TAB_KEYS, names)


@query("d4_label_encode")
def d4_label_encode(spark, sf):
    s = imp.fill_unknown(fx.subjects(spark, sf).select("id", "c_mktsegment"), ["c_mktsegment"])
    classes = enc.fit_label_encode(s, ["c_mktsegment"])
    return enc.apply_label_encode(s, classes).select("id", F.col("c_mktsegment").alias("code"))


# ------------------------------------------------------- feature selection (F)


def _tab_features(spark, sf):
    t = fx.tab(spark, sf)
    st = prep.fit(t, _tab_cfg("median"))
    lab = t.where(F.col("y").isNotNull())
    return prep.features(lab, st, keep=[*TAB_KEYS, "y"]), st


def _onehot_features(spark, sf):
    t = fx.tab(spark, sf).where(F.col("y").isNotNull())
    cats = enc.fit_categories(t, ["o_orderstatus", "c_mktsegment"])
    ex = [e for c in ["o_orderstatus", "c_mktsegment"] for e in enc.onehot_exprs(c, cats[c])]
    return t.select("o_orderkey", "y", F.array(*ex).alias("features"))


def _score_table(spark, sel: "fsel.Selection", p: int):
    kept = set(sel.indices or [])
    rows = [(i, None if sel.scores.get(i) is None else round(float(sel.scores[i]), 6), i in kept) for i in range(p)]
    return spark.createDataFrame(rows, "fi int, score double, selected boolean")


def _stat_scores(spark, sel):
    """The fitted selection's scores (computed by the Spark aggregate during
    fitting, one per feature) with the kept flag; nothing is recomputed."""
    kept = set(sel.indices or [])
    rows = [(int(i), None if v is None else round(float(v), 6), int(i) in kept) for i, v in sorted(sel.scores.items())]
    return spark.createDataFrame(rows, "fi int, score double, selected boolean")


@query("f0_none")
def f0_none(spark, sf):
    feats, st = _tab_features(spark, sf)
    sel = fsel.fit_select(feats, "none", "y")
    return prep.explode_features(fsel.apply_select(feats, sel), TAB_KEYS, st.feature_names)


@query("f10_variance_threshold")
def f10_variance_threshold(spark, sf):
    feats, _ = _tab_features(spark, sf)
    sel = fsel.fit_select(feats, "variance_threshold", "y", threshold=0.01)
    return _stat_scores(spark, sel)


@query("f7_f_classif")
def f7_f_classif(spark, sf):
    feats, _ = _tab_features(spark, sf)
    sel = fsel.fit_select(feats, "f_classif", "y", k=4)
    return _stat_scores(spark, sel)


@query("f8_chi2")
def f8_chi2(spark, sf):
    feats = _onehot_features(spark, sf)
    sel = fsel.fit_select(feats, "chi2", "y", k=4)
    return _stat_scores(spark, sel)


@query("f6_mutual_info")
def f6_mutual_info(spark, sf):
    feats, _ = _tab_features(spark, sf)
    sel = fsel.fit_select(feats, "k_best", "y", k=4, bins=10)
    return _stat_scores(spark, sel)


@query("f6_mutual_info_neighbours")
def f6_mutual_info_neighbours(spark, sf):
    """The library's estimator: neighbours along each feature, within the class and in all."""
    feats, _ = _tab_features(spark, sf)
    return _stat_scores(spark, fsel.fit_select(feats, "mutual_info", "y", k=4))


@query("f11_correlation_threshold")
def f11_correlation_threshold(spark, sf):
    feats, st = _tab_features(spark, sf)
    p = len(st.feature_names)
    idx, ry, drop = fsel.correlation_select(feats, "y", threshold=0.9, target_threshold=0.01, width=p)
    rows = [(i, None if ry.get(i) is None else round(abs(ry[i]), 6), i in drop, i in set(idx)) for i in range(p)]
    return spark.createDataFrame(rows, "fi int, abs_r double, redundant boolean, selected boolean")


@query("f12_apply_selection")
def f12_apply_selection(spark, sf):
    """Fit f_classif (k=4) on training rows, apply to aligned new rows."""
    feats, st = _tab_features(spark, sf)
    sel = fsel.fit_select(feats, "f_classif", "y", k=4)
    new = prep.features(prep.align(fx.tab_new(spark, sf), st, keep=TAB_KEYS), st, keep=TAB_KEYS)
    names = [st.feature_names[i] for i in sel.indices]
    return prep.explode_features(fsel.apply_select(new, sel), TAB_KEYS, names)


def _model_query(method, **kw):
    def run(spark, sf):
        feats, st = _tab_features(spark, sf)
        sel = fsel.fit_select(feats, method, "y", **kw)
        return _score_table(spark, sel, len(st.feature_names))
    return run


QUERIES["f1_lasso"] = _model_query("lasso")
QUERIES["f2_lasso_cv"] = _model_query("lasso_cv", k=4)
QUERIES["f3_random_forest"] = _model_query("random_forest", k=4)
QUERIES["f4_rf_importance"] = _model_query("rf_importance", k=4)
QUERIES["f5_logistic_regression"] = _model_query("logistic_regression", k=4)


@query("f9_pca")
def f9_pca(spark, sf):
    feats, _ = _tab_features(spark, sf)
    sel = fsel.fit_select(feats, "pca", "y", k=3)
    out = fsel.apply_select(feats, sel)
    return out.select("o_orderkey", *[F.round(F.col("features")[i], 6).alias(f"PC{i + 1}") for i in range(3)])


# ------------------------------------------------------------- scoring (E)

# Supplied model weights for the scoring queries (the reference ships none):
# generated by ``score.rule_weights`` so the oracle can embed the same numbers.
MLP_NET = sco.mlp_weights([3, 4, 4], salt=0)
HWN_NET = {"proj": None,
           "layers": [(sco.rule_weights(3, 3, 10 + i), sco.rule_bias(3, 10 + i)) for i in range(2)],
           "gates": [(sco.rule_weights(3, 3, 20 + i), sco.rule_bias(3, 20 + i)) for i in range(2)],
           "out": (sco.rule_weights(4, 3, 30), sco.rule_bias(4, 30))}
HYB_NET = {"lstm": [(sco.rule_weights(16, 3, 40, 0.05), sco.rule_weights(16, 4, 41), sco.rule_bias(16, 42),
                     sco.rule_bias(16, 43))],
           "static": (sco.rule_weights(8, 3, 44), sco.rule_bias(8, 44)),
           "fc1": (sco.rule_weights(8, 12, 45), sco.rule_bias(8, 45)),
           "fc2": (sco.rule_weights(4, 8, 46), sco.rule_bias(4, 46))}


def _static_train(spark, sf):
    st = _subj_state(spark, sf)
    return sp.static_vector(sch.drop_missing_target(fx.subjects(spark, sf), "sii"), st)


def _probs_out(df, key="id", n=4):
    return df.select(key, "prediction", *[F.round(F.col("probability")[i], 6).alias(f"p{i}") for i in range(n)])


@query("e3_score_mlp")
def e3_score_mlp(spark, sf):
    return _probs_out(sco.score_mlp(_static_train(spark, sf), MLP_NET, col="static"))


@query("e4_score_highway")
def e4_score_highway(spark, sf):
    return _probs_out(sco.score_highway(_static_train(spark, sf), HWN_NET, col="static"))


@query("e5_score_hybrid")
def e5_score_hybrid(spark, sf):
    st = _subj_state(spark, sf)
    s = sp.assemble(fx.subjects(spark, sf), fx.series(spark, sf), st, SER_ORDER, EVERY, TAIL, labelled=False)
    return _probs_out(sco.score_hybrid(s, HYB_NET))


@query("e5_predict_series")
def e5_predict_series(spark, sf):
    """The series submission: hybrid predictions, −1 without a series, as CSV and back."""
    import uuid
    from tessera.session import ensure_checkpoint_dir
    got = sp.predict_series(fx.subjects(spark, sf), fx.series(spark, sf), _subj_state(spark, sf), HYB_NET, SER_ORDER, EVERY, TAIL)
    path = f"{ensure_checkpoint_dir(spark)}/series-submission-{uuid.uuid4().hex}"
    io.write_predictions(got, path, "id", "prediction", out_name="sii")
    return spark.read.option("header", True).schema("id string, sii int").csv(path)


@query("e6_softmax_argmax")
def e6_softmax_argmax(spark, sf):
    p = sco.softmax_argmax(_pred(spark, sf), n_classes=3)
    return p.select("y", "yhat", "prediction", *[F.round(F.col("probability")[i], 6).alias(f"p{i}") for i in range(3)])


@query("e7_nan_logits")
def e7_nan_logits(spark, sf):
    p = _pred(spark, sf)
    lg = F.col("logits")
    p = p.withColumn("logits", F.array(lg[0], F.when(F.col("partkey") % 5 == 0, F.lit(float("nan"))).otherwise(lg[1]),
                                       lg[2]))
    p = sco.softmax_argmax(p, n_classes=3)
    return p.select("y", "prediction", *[F.round(F.col("probability")[i], 6).alias(f"p{i}") for i in range(3)])


@query("b13_predictions_for")
def b13_predictions_for(spark, sf):
    """Every subject gets a prediction; subjects without a series get -1."""
    st = _subj_state(spark, sf)
    subj = fx.subjects(spark, sf)
    have = sch.restrict_to_available(subj, fx.series(spark, sf))
    scored = sco.score_mlp(sp.static_vector(have, st), MLP_NET, col="static")
    return sch.predictions_for(subj, scored, "id", "prediction")


@query("e1_fit_mlp")
def e1_fit_mlp(spark, sf):
    v = fx.vec(spark, sf)
    m = sco.fit_mlp(v, "label", hidden=(8,), max_iter=1000)   # ends by its tolerance
    from pyspark.ml.functions import array_to_vector
    out = m.transform(v.withColumn("_v", array_to_vector("features")))
    return out.select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"))


@query("e1_fit_relu_network")
def e1_fit_relu_network(spark, sf):
    """Linear-ReLU-linear with class weights, trained on three classes until the loss stops falling: the classes
    lie apart, so that the trained network tells each row's."""
    from tessera.operators import train
    v = bal.with_class_weights(fx.vec(spark, sf).where("label < 3"), "label")
    fit = train.fit_network(v, "label", hidden=(8,), weight="weight", l2=1e-4, tol=1e-3)
    got = sco.score_mlp(v, fit.layers, keep=["vec_id", "label"])
    return got.select("vec_id", "label", F.array(*[F.lit(c) for c in fit.classes]).getItem(F.col("prediction")).alias("prediction"))


@query("e2_fit_weighted_linear")
def e2_fit_weighted_linear(spark, sf):
    feats, _ = _tab_features(spark, sf)
    w = bal.with_class_weights(feats, "y")
    net = sco.fit_weighted_linear(w, "y", "weight", max_iter=1000)   # ends by its tolerance
    return sco.score_mlp(feats, net, keep=["o_orderkey", "y"]).select("o_orderkey", "y", "prediction")


# ------------------------------------------------ neighbour family


@query("c3_knn_impute")
def c3_knn_impute(spark, sf):
    t = fx.tab(spark, sf).select("o_orderkey", "o_totalprice", "c_acctbal")
    out = knn.knn_impute(t, "o_orderkey", ["o_totalprice", "c_acctbal"], k=5)
    return out.select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"),
                      F.round("c_acctbal", 6).alias("c_acctbal"))


WIDE = 10


def _wide(spark, sf):
    """Ten coordinates of the embeddings, about a fifth of them missing, in hundreds of patterns."""
    v = fx.vec(spark, sf)
    gone = lambda i: F.expr(f"(vec_id * {7 + i} + {13 * i} + vec_id div {i + 2}) % 5 = 0")
    return v.select("vec_id", *[F.when(~gone(i), F.col("features")[i]).alias(f"x{i}") for i in range(WIDE)])


@query("c3_knn_impute_wide")
def c3_knn_impute_wide(spark, sf):
    cols = [f"x{i}" for i in range(WIDE)]
    out = knn.knn_impute(_wide(spark, sf), "vec_id", cols, k=5)
    return out.select("vec_id", *[F.round(c, 6).alias(c) for c in cols])


@query("c3_knn_impute_nan")
def c3_knn_impute_nan(spark, sf):
    t = fx.with_nan(fx.tab(spark, sf).select("o_orderkey", *TAB_NUM), *TAB_NUM)
    out = knn.knn_impute(t, "o_orderkey", list(TAB_NUM), k=5)
    return out.select("o_orderkey", *[F.round(c, 6).alias(c) for c in TAB_NUM])


@query("g4_smote")
def g4_smote(spark, sf):
    out = knn.smote(fx.vec(spark, sf), "label", "vec_id", "features", k=5, seed=42)
    return out.select("vec_id", "label", "synthetic", F.posexplode("features").alias("dim", "value")) \
              .select("vec_id", "label", "synthetic", F.col("dim").cast("int").alias("dim"),
                      F.round("value", 6).alias("value"))


# ------------------------------------------------------- end-to-end pipeline
@query("p1_fit_transform_fclassif_under")
def p1_fit_transform_fclassif_under(spark, sf):
    """DataPreprocessor-style run: median impute, f_classif top-4, random
    under-sampling; long form of the kept rows' selected features."""
    cfg = _tab_cfg("median", fts="f_classif", k_best=4, imb="random_under")
    x, st, _ = prep.fit_transform(fx.tab(spark, sf), cfg)
    return prep.explode_features(x, TAB_KEYS, st.selected_names)


@query("p2_transform_new_rows")
def p2_transform_new_rows(spark, sf):
    cfg = _tab_cfg("median", fts="f_classif", k_best=4)
    _, st, _ = prep.fit_transform(fx.tab(spark, sf), cfg)
    return prep.explode_features(prep.transform(fx.tab_new(spark, sf), st), TAB_KEYS, st.selected_names)


# ---------------------------------------------------------- sources (A)


@query("a1_read_table_string_key")
def a1_read_table_string_key(spark, sf):
    """A1/A2: scan with a declared schema (no inference pass), key forced to string."""
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, IntegerType
    schema = StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType()),
                         StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
                         StructField("c_mktsegment", StringType())])
    df = io.read_table(spark, f"{sf}/customer.parquet", schema=schema, string_cols=["c_custkey"])
    return df.select("c_custkey", "c_acctbal")


@query("a3_read_series_layout")
def a3_read_series_layout(spark, sf):
    """A3: write the series as an ``id=<subject>`` layout into the shared
    checkpoint folder, then read it back in one scan (ids stay strings)."""
    import uuid
    from tessera.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark)}/series-{uuid.uuid4().hex}"
    io.write_series(fx.series(spark, sf), path, "id", SER_ORDER)
    back = io.read_series(spark, path)
    return back.select("id", "event_id", F.round("value", 6).alias("value"), F.round("k", 6).alias("k"))


@query("a8_profile")
def a8_profile(spark, sf):
    return io.profile(fx.table(spark, sf, "customer"), 5, ["c_custkey"]) \
        .select(*[F.col(c) for c in ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]],
                F.col("n_rows").cast("bigint"), F.col("n_cols").cast("int"))


TAB_NET = sco.mlp_weights([4, 4, 5], salt=50)


@query("e3_predict_new_rows")
def e3_predict_new_rows(spark, sf):
    """The inference script as one plan: state fitted on labelled rows
    (median impute, f_classif top-4), new rows aligned and scored."""
    cfg = _tab_cfg("median", fts="f_classif", k_best=4)
    _, st, _ = prep.fit_transform(fx.tab(spark, sf), cfg)
    return _probs_out(prep.predict_new(fx.tab_new(spark, sf), st, TAB_NET), n=5)


@query("f9_series_static_pca")
def f9_series_static_pca(spark, sf):
    """Series path selection: static numerics → PC1, PC2 (scaled) + codes."""
    subj = fx.subjects(spark, sf)
    st = sp.fit_static(subj, "id", "sii", feature_selection="pca", n_features=2)
    v = sp.static_vector(sch.drop_missing_target(subj, "sii"), st)
    return v.select("id", *[F.round(F.col("static")[i], 6).alias(n) for i, n in enumerate(st.num + st.cat)])


@query("a5_prediction_sink")
def a5_prediction_sink(spark, sf):
    """A5: the submission (``id,sii``, −1 for subjects without a series)
    written as CSV by the executors into the shared folder, read back."""
    import uuid
    from tessera.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark)}/submission-{uuid.uuid4().hex}"
    io.write_predictions(b13_predictions_for(spark, sf), path, "id", "prediction", out_name="sii")
    return spark.read.option("header", True).schema("id string, sii int").csv(path)


@query("a7_metrics_history")
def a7_metrics_history(spark, sf):
    """One report row per epoch put into a history partitioned by run and
    epoch, the second epoch twice as a retried job does, read back."""
    import uuid
    from tessera.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark)}/history-{uuid.uuid4().hex}"
    run = io.run_name(mod="mlp", fts="f_classif", k=4, imb="class_weight")
    rep = met.report(_pred(spark, sf), batch="batch", n_classes=3)
    for epoch in (1, 2, 2):
        io.append_metrics(_r6(rep).withColumn("epoch", F.lit(epoch)).withColumn("run", F.lit(run)), path)
    return io.read_metrics(spark, path).select("run", "epoch", "loss", "accuracy", "balanced_accuracy",
                                           "precision", "recall", "f1")


@query("c3_pipeline_knn")
def c3_pipeline_knn(spark, sf):
    """DataPreprocessor with imp='knn': kNN-imputed numerics (donors = the
    labelled training rows, stored in the shared folder) → scale → one-hot."""
    t = fx.tab(spark, sf)
    x, st, _ = prep.fit_transform(t, _tab_cfg("knn"))
    return prep.explode_features(x, TAB_KEYS, st.feature_names)


@query("g6_tab_datasets_fit_all")
def g6_tab_datasets_fit_all(spark, sf):
    """Reference order: fit + f_classif + random under-sampling on all
    labelled rows, then the stratified 80/20 split of the kept rows."""
    cfg = _tab_cfg("median", fts="f_classif", k_best=4, imb="random_under")
    tr, va, _, _ = tabular.tab_datasets(fx.tab(spark, sf), fx.tab_new(spark, sf), cfg, 0.8, "all")
    return tr.select("o_orderkey", "y", F.lit("train").alias("split")) \
             .unionByName(va.select("o_orderkey", "y", F.lit("val").alias("split")))


@query("g6_tab_datasets_fit_train")
def g6_tab_datasets_fit_train(spark, sf):
    """Default order: split first, fit on the training part, transform the
    validation part with that state (long form of both)."""
    cfg = _tab_cfg("median")
    tr, va, st, _ = tabular.tab_datasets(fx.tab(spark, sf), None, cfg, 0.8, "train")
    both = tr.select(*TAB_KEYS, "features").unionByName(va.select(*TAB_KEYS, "features"))
    return prep.explode_features(both, TAB_KEYS, st.feature_names)


@query("b9_series_datasets_both")
def b9_series_datasets_both(spark, sf):
    """Series loaders for split='both': subject split, availability filter,
    batches (shuffled train, ordered val)."""
    sets, _ = sp.series_datasets(fx.subjects(spark, sf), fx.series(spark, sf), SER_ORDER, "both", 0.2,
                                 batch_size=8, every=EVERY, tail=TAIL)
    cols = ["id", "sii", "batch_id", F.col("n_steps").cast("int").alias("n_steps"),
            F.size("padded").cast("int").alias("padded_steps")]
    return sets["train"].select(*cols, F.lit("train").alias("split")).unionByName(
        sets["val"].select(*cols, F.lit("val").alias("split")))
