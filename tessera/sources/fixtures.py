"""Labelled views over the driver tables (see FIXTURES.md §2).

The driver tables hold no nulls, so missing values are injected by key
arithmetic; every view keeps all rows of its source. The same rules are
written as SQL in ``tessera.plans.oracles`` so DuckDB can check results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _null_if(cond, value):
    return F.when(cond, F.lit(None)).otherwise(value)


def tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled training table: orders joined to their customer.

    key ``o_orderkey``; numeric ``o_totalprice``, ``c_acctbal``; categorical
    ``o_orderstatus``, ``c_mktsegment``; label ``y`` (priority 0..4).
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(k,
                    _null_if(k % 11 == 0, F.col("o_totalprice")).alias("o_totalprice"),
                    _null_if(k % 7 == 0, F.col("c_acctbal")).alias("c_acctbal"),
                    _null_if(k % 5 == 0, F.col("o_orderstatus")).alias("o_orderstatus"),
                    F.col("c_mktsegment"),
                    _null_if(k % 13 == 0, F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("y")))


def tab_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New (unlabelled) rows: ``o_orderstatus`` and ``c_acctbal`` absent,
    an extra ``o_custkey`` present — exercises schema alignment."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(k,
                    _null_if(k % 11 == 0, F.col("o_totalprice")).alias("o_totalprice"),
                    F.col("o_custkey"),
                    F.col("c_mktsegment")))


def with_nan(df: DataFrame, *cols: str) -> DataFrame:
    """The same view with NaN where the columns hold null: to be treated alike."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols})


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static per-subject table for the series path: one row per customer,
    id forced to string; label ``sii`` in 0..3, null for some subjects."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(k.cast("string").alias("id"),
                    _null_if(k % 7 == 0, F.col("c_acctbal")).alias("c_acctbal"),
                    F.col("c_nationkey").cast("double").alias("c_nationkey"),
                    _null_if(k % 10 == 0, F.col("c_mktsegment")).alias("c_mktsegment"),
                    _null_if(k % 9 == 0, F.col("c_nationkey") % 4).alias("sii"))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-subject series from ``events``: subject ``id`` (string), order
    ``(ts, event_id)``, numeric ``value`` (with gaps) and ``k``, and a string
    column ``event_type`` that numeric-only steps drop."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("id"),
                    "ts", "event_id",
                    _null_if(F.col("event_id") % 7 < 2, F.col("value")).alias("value"),
                    F.get_json_object("props", "$.k").cast("double").alias("k"),
                    "event_type")


def doc_lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with (imbalanced, partly missing) quality labels."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source",
                                                  F.col("n_chars").cast("double").alias("n_chars"))
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left")


def vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as array<double> features with a 10-class label."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification outcomes over ``lineitem``: y from the return flag, a
    keyed distortion as prediction ``yhat``, ``partkey`` (drives the logits
    of ``pred_logits``) and a ``batch`` of lines."""
    li = table(spark, sf_dir, "lineitem")
    y = (F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2))
    s = F.col("l_orderkey") + F.col("l_linenumber")
    yhat = (F.when(s % 4 == 0, (y + 1) % 3).when(s % 9 == 0, (y + 2) % 3).otherwise(y))
    return li.select(y.alias("y"), yhat.alias("yhat"), F.col("l_partkey").alias("partkey"),
                     (F.col("l_orderkey") % 97).alias("batch"))


def pred_logits(df: DataFrame, n_classes: int = 3) -> DataFrame:
    """Add ``logits`` (array of 3): 2.0 at the predicted class, else
    0.5 * ((partkey + c) mod 3)."""
    def logit(c):
        return F.when(F.col("yhat") == c, F.lit(2.0)).otherwise(0.5 * ((F.col("partkey") + c) % 3))
    return df.withColumn("logits", F.array(*[logit(c) for c in range(n_classes)]))
