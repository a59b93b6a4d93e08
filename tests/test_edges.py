"""Edge cases of FIXTURES §3: empty frame, one class, all-null column,
unseen category, subject without series."""

from pyspark.sql import functions as F

from tessera.operators import encode as enc
from tessera.operators import balance as bal
from tessera.operators import metrics as met
from tessera.operators import schema as sch
from tessera.operators import series as ser
from tessera.plans import prep
from tessera.plans import series_prep as sp


def test_empty_frame_fit_and_transform(spark):
    df = spark.createDataFrame([], "id long, x double, c string, y int")
    st = prep.fit(df, prep.PrepConfig(target="y", keys=("id",), imp="median"))
    assert st.num == [] and st.cat == [] and set(st.dropped) == {"x", "c"}
    assert prep.features(df, st, keep=["id"]).count() == 0


def test_single_class_balancing_and_split(spark):
    df = spark.createDataFrame([(i, 0) for i in range(10)], "k long, y int")
    assert bal.random_under(df, "y", "k").count() == 10
    assert bal.random_over(df, "y", "k").count() == 10
    s = bal.stratified_split(df, "y", "k", 0.2)
    assert s.where("split = 'val'").count() == 2
    w = bal.class_weights(df, "y").first()
    assert w["weight"] == 1.0


def test_all_null_column_dropped_in_pipeline(spark):
    df = spark.createDataFrame([(1, None, 1.0, 0), (2, None, 2.0, 1)], "id long, a double, b double, y int")
    st = prep.fit(df, prep.PrepConfig(target="y", keys=("id",), imp="mean"))
    assert st.dropped == ["a"] and st.feature_names == ["b"]


def test_unseen_category_encodes_to_zeros(spark):
    tr = spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "id long, c string, y int")
    st = prep.fit(tr, prep.PrepConfig(target="y", keys=("id",), imp="mean"))
    new = spark.createDataFrame([(3, "zzz")], "id long, c string")
    assert prep.transform(new, st).first()["features"] == [0.0, 0.0]


def test_subject_without_series_gets_minus_one(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    preds = spark.createDataFrame([("a", 2)], "id string, prediction int")
    got = {r["id"]: r["prediction"] for r in sch.predictions_for(ids, preds).collect()}
    assert got == {"a": 2, "b": -1}


def test_series_all_null_subject_and_empty(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None)], "id string, t long, v double")
    assert [r["v"] for r in ser.fill_series(df, "id", ["t"], ["v"]).collect()] == [0.0, 0.0]
    empty = spark.createDataFrame([], "id string, t long, v double")
    assert ser.fill_series(empty, "id", ["t"], ["v"], every=10, tail=5).count() == 0


def test_metrics_with_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "y int, yhat int")
    r = met.scores(met.confusion(df)).first()
    assert abs(r["accuracy"] - 1 / 3) < 1e-12
    assert abs(r["precision"] - (1 / 3) * (1 / 3)) < 1e-12    # classes 1, 2 predicted never → 0
    assert abs(r["balanced_accuracy"] - 1 / 3) < 1e-12


def test_drop_missing_target_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "y double")
    assert sch.drop_missing_target(df, "y").count() == 1


def test_align_adds_missing_and_drops_extra(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "id long, extra double, c string")
    out = sch.align_columns(df, ["n", "c", "m"], ["m"], {"n": "double"}, keep=["id"])
    r = out.first()
    assert out.columns == ["id", "n", "c", "m"] and r["n"] is None and r["m"] == "0"


def test_series_static_selection(spark):
    from tessera.plans import series_prep as sp
    from tessera.sources import fixtures as fx
    from tests.conftest import SF
    subj = fx.subjects(spark, SF)
    st = sp.fit_static(subj, "id", "sii", feature_selection="mutual_info", n_features=1)
    assert len(st.num) == 1 and st.num[0] in ("c_acctbal", "c_nationkey")
    v = sp.static_vector(subj, st).first()["static"]
    assert len(v) == 2                                  # 1 numeric + 1 label code
    st = sp.fit_static(subj, "id", "sii", feature_selection="pca", n_features=2)
    assert st.num == ["PC1", "PC2"]
    rows = sp.static_vector(subj.where("sii IS NOT NULL"), st).collect()
    import numpy as np
    pcs = np.array([r["static"][:2] for r in rows])
    assert np.allclose(pcs.mean(axis=0), 0, atol=1e-9) and np.allclose(pcs.std(axis=0), 1, atol=1e-9)


def test_columns_with_too_many_categories_become_sparse(spark):
    """Beyond max_categories a column's categories stay a table; the vectors hold the same values, sparse."""
    rows = [(i, f"v{i % 29:02}", "a" if i % 3 else None, float(i), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, wide string, narrow string, x double, y int")
    cfg = lambda n, **kw: prep.PrepConfig(target="y", keys=("id",), max_categories=n, **kw)
    dense, few = prep.fit_transform(df, cfg(100))[:2]
    sparse, many = prep.fit_transform(df, cfg(20))[:2]
    assert list(many.tables) == ["wide"] and many.width == few.width == 31 and many.cat_fill == few.cat_fill
    want = {r["id"]: r["features"] for r in dense.collect()}
    full = lambda x: {r["id"]: r["features"] for r in prep.densify(x).collect()}
    assert full(sparse) == want
    import json
    back = prep.PrepState.from_json(json.dumps(json.loads(many.to_json())))
    new = df.drop("y", "narrow").unionByName(spark.createDataFrame([(100, "unseen", 3.0), (101, None, None)], "id long, wide string, x double"))
    assert full(prep.transform(new, back)) == {r["id"]: r["features"] for r in prep.transform(new, few).collect()}
    assert prep.names_at(spark, many, range(31)) == few.feature_names
    # selection, PCA, class balance and kNN imputation on either
    for kw in (dict(fts="f_classif", k_best=3), dict(fts="pca", k_best=2), dict(imb="smote"), dict(imp="knn")):
        a, b = (prep.fit_transform(df, cfg(n, **kw)) for n in (100, 20))
        assert a[1].selected_names == b[1].selected_names
        if kw.get("imp") or kw.get("imb"):
            continue
        rows = [{r["id"]: r["features"] for r in prep.transform(df.drop("y"), st).collect()} for st in (a[1], b[1])]
        assert rows[0].keys() == rows[1].keys() and all(abs(p - q) < 1e-9 for i in rows[0] for p, q in zip(rows[0][i], rows[1][i]))


def test_label_codes_of_any_number(spark):
    import pytest
    df = spark.createDataFrame([(i, f"w{i % 40:02}" if i % 9 else None, "ab"[i % 2], i % 3) for i in range(90)], "id long, c string, d string, sii int")
    for unseen in ("keep", "error"):
        rows = [enc.apply_label_encode(df.where("c IS NOT NULL"), enc.fit_label_encode(df, ["c", "d"], n), unseen).collect() for n in (100, 20)]
        assert sorted(map(tuple, rows[0])) == sorted(map(tuple, rows[1]))
    wide = enc.fit_label_encode(df.where("id < 50"), ["c"], 5)
    with pytest.raises(Exception, match="unseen label"):
        enc.apply_label_encode(df.withColumn("c", F.lit("nowhere")), wide).collect()
    vectors = []
    for n in (100, 20):
        st = sp.fit_static(df, "id", "sii", max_categories=n)
        st = sp.SeriesState.from_json(st.to_json())
        vectors.append({r["id"]: r["static"] for r in sp.static_vector(df.withColumn("c", F.when(F.col("id") == 7, "new").otherwise(F.col("c"))), st).collect()})
    assert vectors[0] == vectors[1] and bool(st.tables)
