import os
import tempfile

from pyspark.sql import functions as F

from tessera.operators import score as sco
from tessera.plans import prep
from tessera.sources import fixtures as fx
from tessera.sources import io
from tessera.streaming import inference
from tests.conftest import SF


def _tmp():
    return tempfile.mkdtemp(prefix="tessera-test-")


def test_csv_read_inferred_and_string_key(spark):
    d = _tmp()
    spark.createDataFrame([("007", 1.5, "a"), ("010", None, "b")], "id string, x double, c string") \
        .coalesce(1).write.option("header", True).mode("overwrite").csv(d + "/t")
    df = io.read_table(spark, d + "/t", fmt="csv")
    assert dict(df.dtypes)["id"] == "int"                       # inference loses the zeros
    df = io.read_table(spark, d + "/t", fmt="csv", string_cols=["id"])
    assert sorted(r["id"] for r in df.collect()) == ["007", "010"] and dict(df.dtypes)["x"] == "double"
    from pyspark.sql.types import DoubleType, LongType, StringType, StructType
    sch = StructType().add("id", LongType()).add("x", DoubleType()).add("c", StringType())
    df = io.read_table(spark, d + "/t", schema=sch, fmt="csv", string_cols=["id"])
    assert sorted(r["id"] for r in df.collect()) == ["007", "010"]


def test_partitioned_series_layout_keeps_string_ids(spark):
    d = _tmp()
    s = fx.series(spark, SF).withColumn("id", F.lpad("id", 3, "0"))
    s.write.partitionBy("id").mode("overwrite").parquet(d + "/series")
    back = io.read_series(spark, d + "/series")
    assert dict(back.dtypes)["id"] == "string"
    one = io.read_subject(back, "id", "007")
    assert one.count() == s.where("id = '007'").count() > 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partition" in plan.lower()
    io.require_ids(back, "id", ["007"])
    try:
        io.require_ids(back, "id", ["999"])
        raise AssertionError("expected a missing-subject error")
    except ValueError:
        pass


def test_prediction_sink_and_metrics_history(spark):
    d = _tmp()
    preds = spark.createDataFrame([("a", 1), ("b", -1)], "id string, prediction int")
    io.write_predictions(preds, d + "/sub", out_name="sii")
    back = spark.read.option("header", True).csv(d + "/sub")
    assert back.columns == ["id", "sii"] and back.count() == 2
    m = spark.createDataFrame([("run1", 1, 0.5), ("run1", 2, 0.4)], "run string, epoch int, loss double")
    io.append_metrics(m, d + "/hist")
    io.append_metrics(m.withColumn("run", F.lit("run2")), d + "/hist")
    assert io.read_metrics(spark, d + "/hist").groupBy("run").count().count() == 2


def test_metrics_of_a_repeated_step_replace_its_rows(spark):
    d = _tmp()
    row = lambda *r: spark.createDataFrame([r], "run string, epoch int, loss double")
    for r in (("run=a/b", 1, 0.5), ("run=a/b", 2, 0.4), ("run=a/b", 2, 0.3), (None, 1, 0.2), ("007", 10, 0.1), (None, 1, 0.6)):
        io.append_metrics(row(*r), d)
    want = {("run=a/b", 1, 0.5), ("run=a/b", 2, 0.3), (None, 1, 0.6), ("007", 10, 0.1)}
    assert {(r.run, r.epoch, r.loss) for r in io.read_metrics(spark, d).collect()} == want
    io.append_metrics(row("x", 1, 0.0).limit(0), d)  # no rows: no step
    # a job that ended before its marker: its step is not shown, until it runs again
    (row("late", 1, 0.9).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "epoch").parquet(d + "/history"))
    assert {(r.run, r.epoch, r.loss) for r in io.read_metrics(spark, d).collect()} == want
    io.append_metrics(row("late", 1, 0.8), d)
    assert {(r.run, r.epoch, r.loss) for r in io.read_metrics(spark, d).collect()} == want | {("late", 1, 0.8)}


def test_profile(spark):
    p = io.profile(fx.table(spark, SF, "orders"), 3, ["o_orderkey"]).collect()
    assert len(p) == 3 and p[0]["n_cols"] == 6 and p[0]["n_rows"] > 0


def test_state_save_load(spark):
    d = _tmp()
    t = fx.tab(spark, SF)
    cfg = prep.PrepConfig(target="y", keys=("o_orderkey",), imp="mean", fts="f_classif", k_best=3)
    _, st, _ = prep.fit_transform(t, cfg)
    prep.save_state(spark, st, d + "/state")
    st2 = prep.load_state(spark, d + "/state")
    a = prep.transform(fx.tab_new(spark, SF), st).orderBy("o_orderkey").limit(20).collect()
    b = prep.transform(fx.tab_new(spark, SF), st2).orderBy("o_orderkey").limit(20).collect()
    assert a == b and len(a[0]["features"]) == 3


def test_streaming_inference_matches_batch(spark):
    d = _tmp()
    t = fx.tab(spark, SF)
    cfg = prep.PrepConfig(target="y", keys=("o_orderkey",), imp="median")
    _, st, _ = prep.fit_transform(t, cfg)
    new = fx.tab_new(spark, SF)
    new.repartition(3).write.mode("overwrite").parquet(d + "/in")
    layers = sco.mlp_weights([len(st.feature_names), 4, 3], salt=9)
    stream = inference.read_new_rows(spark, d + "/in", new.schema, max_files=1)
    q = inference.start_predictions(inference.score_stream(stream, st, layers), d + "/out", d + "/ckpt")
    q.awaitTermination(120)
    got = spark.read.parquet(d + "/out")
    batch = sco.score_mlp(prep.transform(new, st), layers, keep=["o_orderkey"]) \
        .select(F.col("o_orderkey").alias("id"), "prediction")
    assert got.count() == new.count()
    assert got.exceptAll(batch).count() == 0


def test_run_name_and_long_id_list(spark):
    assert io.run_name(mod="mlp", fts="f_classif", k=4) == "mod=mlp-fts=f_classif-k=4"
    s = fx.series(spark, SF)
    ids = [str(i) for i in range(2000)]          # > 1000: anti-join path
    try:
        io.require_ids(s, "id", ids)
        raise AssertionError("expected missing subjects")
    except ValueError as e:
        assert "subject" in str(e)
    have = [r[0] for r in s.select("id").distinct().collect()]
    io.require_ids(s, "id", have)
