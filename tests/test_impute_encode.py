import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import encode, impute
from tessera.plans import prep


def test_exact_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "x double")
    assert impute.exact_quantiles(df, ["x"])["x"] == 3.0


def test_exact_median_refine_path_matches_sort(spark):
    rnd = random.Random(7)
    vals = [float(rnd.randint(0, 5000)) for _ in range(3001)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(4)
    got = impute.exact_quantiles(df, ["x"], accuracy=100, max_collect=20)["x"]
    s = sorted(v for v in vals if v is not None)
    assert got == s[len(s) // 2]


def test_exact_quantile_even_count_and_ties(spark):
    vals = [0.0] * 50 + [1.0] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert impute.exact_quantiles(df, ["x"], accuracy=10, max_collect=1)["x"] == 0.5


def test_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string")
    assert impute.most_frequent(df, ["c"]) == {"c": "a"}


def test_all_missing_column_is_dropped(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    st = impute.fit_impute(df, ["a", "b"], "mean")
    assert st.dropped == ["b"]
    assert impute.apply_impute(df, st).columns == ["a"]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(5.0,), (float("nan"),), (7.0,)], "x double")
    st = impute.fit_impute(impute.normalize_nan(df, ["x"]), ["x"], "mean")
    assert st.fills["x"] == 6.0


def test_zero_variance_scale_is_one(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "c double, v double")
    st = encode.fit_scale(df, ["c", "v"])
    assert st.scale["c"] == 1.0 and st.scale["v"] == 0.5   # population std of {1, 2}
    out = encode.apply_scale(df, st).collect()
    assert [r["c"] for r in out] == [0.0, 0.0]


def test_onehot_unseen_and_null_are_all_zero(spark):
    df = spark.createDataFrame([("x",), ("y",)], "c string")
    cats = encode.fit_categories(df, ["c"])
    assert cats == {"c": ["x", "y"]}
    new = spark.createDataFrame([("z",), (None,), ("y",)], "c string")
    rows = new.select(F.array(*encode.onehot_exprs("c", cats["c"])).alias("v")).collect()
    assert [r["v"] for r in rows] == [[0.0, 0.0], [0.0, 0.0], [0.0, 1.0]]


def test_label_encode_unseen_errors(spark):
    df = spark.createDataFrame([("b",), ("a",)], "c string")
    classes = encode.fit_label_encode(df, ["c"])
    assert [r["c"] for r in encode.apply_label_encode(df, classes).collect()] == [1.0, 0.0]
    bad = spark.createDataFrame([("q",)], "c string")
    with pytest.raises(Exception):
        encode.apply_label_encode(bad, classes).collect()
    assert encode.apply_label_encode(bad, classes, unseen="keep").first()["c"] == -1.0


def test_prep_transform_of_fit_rows_equals_fit(spark):
    rows = [(i, float(i) if i % 3 else None, "a" if i % 2 else "b", i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, x double, c string, y int")
    st = prep.fit(df, prep.PrepConfig(target="y", keys=("id",), imp="median"))
    a = prep.features(df, st, keep=["id"]).orderBy("id").collect()
    b = prep.features(prep.align(df.drop("y"), st, keep=["id"]), st, keep=["id"]).orderBy("id").collect()
    assert a == b
    assert st.feature_names == ["x", "c_a", "c_b"]
    xs = [v for v in [float(i) if i % 3 else None for i in range(20)] if v is not None]
    import statistics
    assert math.isclose(st.num_fill["x"], statistics.median(xs))


def test_state_json_round_trip(spark):
    df = spark.createDataFrame([(1, 1.0, "a", 0), (2, 3.0, "b", 1)], "id long, x double, c string, y int")
    st = prep.fit(df, prep.PrepConfig(target="y", keys=("id",), imp="mean"))
    assert prep.PrepState.from_json(st.to_json()).to_json() == st.to_json()


def test_value_counts_ride_along_and_overflow_fallback(spark):
    rows = [(float(i % 50), "abc"[i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, "x double, c string")
    for mc in (200_000, 5):                      # fits / overflows the first histogram job
        out = {}
        med = impute.exact_quantiles(df, ["x"], accuracy=10, max_collect=mc, cat_cols=["c"], cat_limit=10,
                                     cat_out=out)
        assert med["x"] == 24.5
        assert out == {"c": {"a": 100, "b": 100, "c": 100}}
