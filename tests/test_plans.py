"""Physical-plan properties the operators are designed for."""

from pyspark.sql import functions as F

from tessera.operators import knn
from tessera.operators.rank import hash_within
from tessera.plans import prep
from tessera.sources import fixtures as fx
from tests.conftest import SF


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_transform_is_a_narrow_projection_over_pruned_scans(spark):
    t = fx.tab(spark, SF)
    st = prep.fit(t, prep.PrepConfig(target="y", keys=("o_orderkey",), imp="median"))
    x = prep.transform(fx.tab_new(spark, SF), st)
    plan = x._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan   # no shuffle of rows
    assert "o_orderstatus" not in plan.split("FileScan")[1].split("\n")[0]     # absent column never read


def test_series_rows_are_exchanged_once(spark):
    import __spark_entry__ as E
    plan = _final_plan(E.queries()["h5_tail"](spark, SF)).split("Initial Plan")[0]
    assert "rangepartitioning" not in plan
    # rows by (id, chunk), the summary's partial sums by the same, and the summary by id
    assert plan.count("Exchange hashpartitioning") <= 3


def test_duplicate_donors_are_limited_before_the_shuffle(spark):
    df = spark.range(0, 200).select(F.col("id").alias("k"), F.array(F.lit(1.0), F.lit(2.0)).alias("vec"))
    out = knn.exact_knn(df, df.withColumnRenamed("k", "d"), "k", "d", "vec", 3, exclude_self=True)
    assert out.count() == 600
    from pyspark.sql import Window
    two = spark.range(0, 200).select(F.col("id").alias("k"),
                                     F.array(F.lit(1.0), (F.col("id") % 2).cast("double")).alias("vec"))
    d0 = two.withColumn("_r", F.row_number().over(Window.partitionBy("vec").orderBy("k"))).where("_r <= 4")
    plan = d0._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_threshold_shuffles_only_boundary_rows(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    r = hash_within(df, "k", 1234, 42, buckets=64)
    assert r.where("_in").count() == 1234
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    assert "_state" in plan and "Union" in plan


def test_report_reads_its_rows_once(spark):
    import __spark_entry__ as E
    plan = _final_plan(E.queries()["m9_report"](spark, SF))
    assert "BroadcastNestedLoopJoin" not in plan and "lineitem" not in plan     # aggregates of the written counts only


def test_validation_rows_keep_their_label_without_a_join(spark):
    from tessera.plans import tabular
    t = fx.tab(spark, SF)
    _, va, _, _ = tabular.tab_datasets(t, None, prep.PrepConfig(target="y", keys=("o_orderkey",)), 0.8, "train")
    assert va.columns == ["o_orderkey", "y", "features"] and va.where("y IS NULL").count() == 0


def test_class_scores_shuffle_a_row_a_class(spark):
    from tessera.operators import select as fsel
    df = spark.range(0, 1000).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("features"), (F.col("id") % 3).alias("y"))
    plan = fsel.anova_scores(df, "y")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate posexplode") < plan.index("Aggregate [y")           # rows are unfolded above the aggregate


def test_knn_state_is_refused_by_the_stream(spark):
    import pytest
    from tessera.streaming import inference
    st = prep.PrepState(config={"keys": ["id"]}, knn_donors="somewhere")
    with pytest.raises(ValueError, match="knn"):
        inference.score_stream(spark.range(1), st, [])


def test_ten_thousand_chunks_plan_and_run(spark):
    """Bounds come from a hash share of the rows, not from one task's top list, and are one literal of the plan."""
    from tessera.functions.ranges import chunk_column
    df = spark.range(0, 700_000).select((F.col("id") * 7919 % 1_000_003).alias("v"), F.concat(F.lit("k"), F.col("id") % 10).alias("s"))
    c = df.select("v", chunk_column(df, ["v", "s"], 10_000).alias("c"))
    got = c.agg(F.max("c").alias("m"), F.count_distinct("c").alias("n")).first()
    assert got["n"] == got["m"] + 1 > 9000
    # ascending with the key, and of like size
    per = c.groupBy("c").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("k")).orderBy("c").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(per, per[1:])) and max(r["k"] for r in per) < 700
    plan = df.select(chunk_column(df, ["v"], 50).alias("c"))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "named_struct" not in plan


def test_chunks_of_every_key_type(spark):
    import datetime as dt
    from decimal import Decimal

    from tessera.functions.ranges import chunk_column
    rows = [(i, f"é\"{i % 40:03}", float(i) / 7, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i % 90), dt.date(2020, 1, 1 + i % 28), Decimal(i) / 3, i % 2 == 0, bytes([i % 200]))
            for i in range(600)] + [(None,) * 8]
    df = spark.createDataFrame(rows, "a long, b string, c double, d timestamp, e date, f decimal(20,6), g boolean, h binary")
    for c in df.columns:
        per = df.where(f"{c} IS NOT NULL").select(F.col(c).alias("v"), chunk_column(df, [c], 6).alias("k")).groupBy("k").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("k").collect()
        assert len(per) >= (2 if c == "g" else 5), c
        assert all(x["hi"] < y["lo"] for x, y in zip(per, per[1:])), c
        assert df.where(f"{c} IS NULL").select(chunk_column(df, [c], 6).alias("k")).first()["k"] == 0
