"""Streaming inference with a fitted state (Structured Streaming).

New rows arrive as files (or any streaming source); each micro-batch is
aligned to the training schema, transformed with the fitted state (a
stateless projection, so no streaming state store is involved), scored by
the supplied network, and written as ``id, prediction``. The sink is
exactly-once: the file sink commits per batch through the checkpoint
location, so a restarted query neither loses nor duplicates batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators import score
from tessera.plans import prep


def read_new_rows(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                  max_files: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def score_stream(stream: DataFrame, st: prep.PrepState, layers, id_col: str | None = None) -> DataFrame:
    """Lazy streaming plan: align → features → selection → MLP scores."""
    if st.knn_donors:
        raise ValueError("a state with imp='knn' searches neighbours in several jobs; a stream needs 'mean' or 'median'")
    keys = list(st.config["keys"])
    x = prep.transform(stream, st)
    out = score.score_mlp(x, layers, col="features", keep=keys)
    return out.select(F.col(id_col or keys[0]).alias("id"), "prediction")


def start_predictions(scored: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                      available_now: bool = True, query_name: str | None = None):
    """Start the sink (append mode). ``available_now`` processes what is
    there and stops (batch-like backfills); otherwise runs continuously."""
    w = scored.writeStream.format(fmt).option("path", sink_path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    if fmt == "csv":
        w = w.option("header", True)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
