"""Sources and sinks.

Reads are lazy scans: column selection and filters written after them reach
the file scan (``ReadSchema`` / ``PushedFilters`` / ``PartitionFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               string_cols=(), fmt: str | None = None) -> DataFrame:
    """A1/A2: scan a CSV (header, inferred or given schema) or Parquet table.

    ``string_cols`` are forced to string (subject ids such as ``007``).
    With a schema the CSV is read without the inference pass over the data.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "csv":
        r = spark.read.option("header", True)
        if schema is None:
            schema = r.option("inferSchema", True).csv(path).schema
        # read as string, never inferred and cast back: "007" must not become "7"
        text = StructType([StructField(f.name, StringType(), f.nullable) if f.name in string_cols else f for f in schema.fields])
        df = r.option("inferSchema", False).schema(text).csv(path)
    else:
        df = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    for c in string_cols:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("string"))
    return df


def write_series(df: DataFrame, path: str, id_col: str = "id", order=(), parts: int | None = None) -> None:
    """A3: the series as an ``id=<subject>/part-*.parquet`` layout, rows of a file in ``order``.

    The rows are exchanged once, by ranges of (id, order…), so that a subject
    lies in one file, or in the files of neighbouring ranges where it is larger
    than a range: there are about as many files as subjects, however many
    tasks read the input. The tasks move their files to their folders
    themselves (a retried task writes the same names again); the driver would
    move them one by one. ``parts``: number of ranges.
    """
    order = [order] if isinstance(order, str) else list(order)
    spark = df.sparkSession
    # a given number: few bytes, but a file for each subject, which adaptive execution would leave to a few tasks
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    (df.repartitionByRange(parts, id_col, *order).sortWithinPartitions(id_col, *order)
     .write.partitionBy(id_col).mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path))


def read_series(spark: SparkSession, path: str, id_col: str = "id") -> DataFrame:
    """A3: one scan over an ``id=<subject>/part-*.parquet`` layout.

    Partition discovery turns the directory names into a string ``id``
    column (type inference of partition values is switched off for this
    read), so ``where(id == x)`` prunes whole directories instead of opening
    one file per subject. Many folders are listed by tasks, several folders a
    task and not one each.
    """
    mine = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false",
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(8 * spark.sparkContext.defaultParallelism)}
    old = {key: spark.conf.get(key, None) for key in mine}
    try:
        for key, value in mine.items():
            spark.conf.set(key, value)
        df = spark.read.parquet(path)
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    if id_col in df.columns:
        df = df.withColumn(id_col, F.col(id_col).cast("string"))
    return df


def read_subject(series: DataFrame, id_col: str, subject) -> DataFrame:
    """A4: rows of one subject (a partition-pruned filter)."""
    return series.where(F.col(id_col) == F.lit(str(subject)))


def require_ids(df: DataFrame, id_col: str, ids) -> None:
    """A4: raise if any requested subject has no rows, naming all of them (at
    most the list that was given)."""
    missing = [r[0] for r in missing_ids(df, id_col, ids).orderBy(id_col).collect()]
    if missing:
        raise ValueError(f"no series rows for subject(s): {missing}")


def missing_ids(df: DataFrame, id_col: str, ids) -> DataFrame:
    """A4: the requested ids (a list, or a frame with ``id_col``) without rows;
    the table's ids are made distinct before the shuffle."""
    if isinstance(ids, DataFrame):
        want = ids.select(F.col(id_col).cast("string").alias(id_col)).distinct()
    else:
        want = df.sparkSession.createDataFrame([(str(i),) for i in dict.fromkeys(ids)], f"{id_col} string")
    return want.join(df.select(F.col(id_col).cast("string").alias(id_col)).distinct(), id_col, "left_anti")


def write_predictions(df: DataFrame, path: str, id_col: str = "id", pred_col: str = "prediction",
                      out_name: str | None = None, fmt: str = "csv") -> None:
    """A5: prediction sink ``id,prediction`` (or ``id,sii``), written by the
    executors in parallel (a folder of part files, header in each)."""
    out = df.select(F.col(id_col).alias("id"), F.col(pred_col).alias(out_name or pred_col))
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def run_name(**params) -> str:
    """Run name from the run's parameters, ``key=value`` joined by '-'."""
    return "-".join(f"{k}={v}" for k, v in params.items()).replace(" ", "")


def append_metrics(df: DataFrame, path: str, run_col: str = "run", step_col: str = "epoch") -> None:
    """Put the rows of ``df`` into a metrics history partitioned by run
    and step, and mark those steps as committed.

    A step that is written again (a retried job, a repeated epoch) replaces
    its former rows, other steps stay. The marker, the number of the step's
    rows, follows the rows, so a job that ends between the two leaves nothing
    that ``read_metrics`` shows.
    """
    from tessera.session import written
    rows = written(df, "metrics")  # computed once: the rows and their markers agree
    marks = rows.groupBy(run_col, step_col).agg(F.count(F.lit(1)).alias("n_rows"))
    for part, folder in ((rows, "history"), (marks, "commits")):
        (part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(run_col, step_col).parquet(f"{path}/{folder}"))


def read_metrics(spark: SparkSession, path: str, run_col: str = "run", step_col: str = "epoch", step_type: str = "int") -> DataFrame:
    """The committed rows of a metrics history. A step is shown if its
    marker counts as many rows as it has; ``step_type`` is the type of the step."""
    history = read_series(spark, f"{path}/history", run_col)
    marks = read_series(spark, f"{path}/commits", run_col).select(
        F.col(run_col).alias("_run"), F.col(step_col).alias("_step"), F.col("n_rows").alias("_n"))
    held = history.groupBy(run_col, step_col).agg(F.count(F.lit(1)).alias("_held"))
    whole = held.join(marks, F.col(run_col).eqNullSafe(F.col("_run")) & F.col(step_col).eqNullSafe(F.col("_step"))).where("_held = _n")
    whole = whole.select(F.col(run_col).alias("_run"), F.col(step_col).alias("_step"))
    got = history.join(whole, F.col(run_col).eqNullSafe(F.col("_run")) & F.col(step_col).eqNullSafe(F.col("_step")), "left_semi")
    return got.withColumn(step_col, F.col(step_col).cast(step_type))


def profile(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """Shape + head preview as one DataFrame: the first ``n`` rows in key
    order, each carrying the table's row and column counts.

    The row count is one global aggregate (partial counts per task, run
    here as an action); the head is a top-n (``TakeOrderedAndProject``),
    not a full sort.
    """
    n_rows = df.count()
    head = df.orderBy(*(order_by or df.columns[:1])).limit(n)
    return head.withColumn("n_rows", F.lit(n_rows)).withColumn("n_cols", F.lit(len(df.columns)))
