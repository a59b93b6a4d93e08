"""Ordered per-subject series.

Forward/back fill, every-n-th down-sampling and keep-last-N are prefix
computations over each subject's ordered rows. A plain
``Window.partitionBy(id)`` would put a whole subject in one task, and a
single subject may hold a large share of all rows. So the scan is chunked:

1. bounds on (id, order…), drawn once and written into the plan as literals,
   cut a hot subject into several ordered chunks; the chunk is a function of
   the row, the same in every branch of the plan;
2. one small aggregate per (id, chunk): row count, last and first non-null
   value of every column (partial sums before its shuffle);
3. a window over that small summary gives each chunk its carry-in (row
   offset, last value before the chunk, first value of the subject);
4. the rows are exchanged once, by (id, chunk), joined with their carry-in and
   finished by local windows over the same (id, chunk).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import NumericType, BooleanType

from tessera.functions.ranges import chunk_column


def numeric_columns(df: DataFrame, exclude=()) -> list:
    """H6: numeric columns (bool excluded), in schema order."""
    return [f.name for f in df.schema.fields if f.name not in exclude
            and isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType)]


#: Columns of a clustered table (``write_clustered``): the chunk of a row, and the subject's part in it, which is never null.
CHUNK, CELL = "_chunk", "_cell"


def _chunked(df: DataFrame, id_col: str, order, cols, chunks: int | None):
    """Rows with their chunk and its carry-in, and the columns that tell the parts of a subject apart."""
    clustered = CELL in df.columns
    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df if clustered else df.withColumn(CHUNK, chunk_column(df, [id_col, *order], n))
    part = [CELL] if clustered else [id_col, CHUNK]
    ordk = F.struct(*[F.col(o) for o in order])
    aggs = [F.count(F.lit(1)).alias("_n")]
    if clustered:  # by the cell alone, as the table lies
        aggs += [F.first(id_col).alias(id_col), F.first(CHUNK).alias(CHUNK)]
    for c in cols:
        present = F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
        aggs.append(F.max_by(F.col(c), F.when(present, ordk)).alias(f"_last_{c}"))
        aggs.append(F.min_by(F.col(c), F.when(present, ordk)).alias(f"_first_{c}"))
    summ = ranged.groupBy(*part).agg(*aggs)
    ws = W.partitionBy(id_col).orderBy(CHUNK)
    before = ws.rowsBetween(W.unboundedPreceding, -1)
    whole = ws.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    carry = summ.select(
        *[F.col(c).alias(f"_to{c}") for c in part],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(whole).alias("_total"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in cols],
        *[F.first(f"_first_{c}", ignorenulls=True).over(whole).alias(f"_head_{c}") for c in cols])
    if clustered:
        on = F.col(CELL) == F.col(f"_to{CELL}")
    else:  # null-safe: a row without an id belongs to the subject "null"
        on = F.col(id_col).eqNullSafe(F.col(f"_to{id_col}")) & (F.col(CHUNK) == F.col(f"_to{CHUNK}"))
    return ranged.join(carry, on), part


def write_clustered(df: DataFrame, table: str, id_col: str, order, path: str | None = None, buckets: int | None = None,
                    chunks: int | None = None) -> None:
    """A3: the series as a table bucketed and sorted by subject and ordered chunk, one file a bucket.

    ``fill_series`` and what builds on it read such a table without exchanging
    its rows; a hot subject lies in as many buckets as it has chunks, and a
    subject costs no folder and no file of its own. ``path``: where the table
    lies, if not in the warehouse. Rows without an id are the subject null.
    """
    order = [order] if isinstance(order, str) else list(order)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or n
    # several cells a bucket, so that a hash deals them out evenly
    rows = df.withColumn(CHUNK, chunk_column(df, [id_col, *order], chunks or 4 * buckets))
    mine = F.col(id_col).cast("string")
    rows = rows.withColumn(CELL, F.concat(F.col(CHUNK).cast("string"), F.coalesce(F.concat(F.lit(":"), mine), F.lit(""))))
    w = rows.repartition(buckets, CELL).write.mode("overwrite").format("parquet").bucketBy(buckets, CELL).sortBy(CELL, *order)
    (w.option("path", path) if path else w).saveAsTable(table)


def fill_series(df: DataFrame, id_col: str, order, cols=None, bfill: bool = True, zero: bool = True,
                every: int | None = None, tail: int | None = None, chunks: int | None = None) -> DataFrame:
    """H1-H5 in one pass: forward fill (NaN counts as missing), then back fill
    of the leading gap (``bfill``), then 0 (``zero``); then keep rows
    0, n, 2n… of each subject (``every``, after filling) and of those the last
    ``tail``. Output keeps the input columns (filled) in input order. A table
    of ``write_clustered`` is taken as it lies: no row is exchanged.
    """
    order = [order] if isinstance(order, str) else list(order)
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=[id_col, CHUNK, *order])
    j, part = _chunked(df, id_col, order, cols, chunks)
    wl = W.partitionBy(*part).orderBy(*order)
    upto = wl.rowsBetween(W.unboundedPreceding, 0)
    sel = []
    for c in df.columns:
        if c in (CHUNK, CELL):
            continue
        if c in cols:
            x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) \
                if df.schema[c].dataType.typeName() in ("double", "float") else F.col(c)
            v = F.coalesce(F.last(x, ignorenulls=True).over(upto), F.col(f"_carry_{c}"))
            if bfill:
                v = F.coalesce(v, F.col(f"_head_{c}"))
            if zero:
                v = F.coalesce(v, F.lit(0).cast(df.schema[c].dataType))
            sel.append(v.alias(c))
        else:
            sel.append(F.col(c))
    rn = (F.col("_off") + F.row_number().over(wl)).alias("_rn")
    out = j.select(*sel, rn, F.col("_total"))
    if every and every > 1:
        out = out.where((F.col("_rn") - 1) % every == 0)
        kept = F.ceil(F.col("_total") / F.lit(every))
        pos = F.floor((F.col("_rn") - 1) / F.lit(every))
    else:
        kept, pos = F.col("_total"), F.col("_rn") - 1
    if tail is not None:
        out = out.where(pos >= kept - F.lit(tail))
    return out.drop("_rn", "_total")


def ffill(df: DataFrame, id_col: str, order, cols=None, **kw) -> DataFrame:
    """H1: forward fill only (remaining leading gaps stay null)."""
    return fill_series(df, id_col, order, cols, bfill=False, zero=False, **kw)


def downsample(df: DataFrame, id_col: str, order, n: int = 10, **kw) -> DataFrame:
    """H4: rows 0, n, 2n… of every subject (no filling)."""
    return fill_series(df, id_col, order, cols=[], every=n, **kw)


def tail(df: DataFrame, id_col: str, order, n: int = 1000, **kw) -> DataFrame:
    """H5: the last n rows of every subject (no filling)."""
    return fill_series(df, id_col, order, cols=[], tail=n, **kw)


def build_sequences(df: DataFrame, id_col: str, order, cols, out: str = "seq") -> DataFrame:
    """H7: one row per subject with the nested sequence [T, F] (NaN/null → 0).

    Run after ``tail``, so every collected group is bounded by the tail cap.
    """
    order = [order] if isinstance(order, str) else list(order)
    step = F.array(*[F.col(c).cast("double") for c in cols])
    g = df.groupBy(id_col).agg(F.array_sort(F.collect_list(
        F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], step.alias("x")))).alias("_s"))
    return g.select(id_col, F.transform("_s", lambda s: F.transform(
        s["x"], lambda v: F.when(v.isNull() | F.isnan(v), F.lit(0.0)).otherwise(v))).alias(out))


def explode_sequences(df: DataFrame, id_col: str, col: str = "seq") -> DataFrame:
    """Long form (id, t, f, value) of a nested sequence column."""
    return (df.select(id_col, F.posexplode(col).alias("t", "_row"))
            .select(id_col, "t", F.posexplode("_row").alias("f", "value"))
            .select(id_col, F.col("t").cast("int").alias("t"), F.col("f").cast("int").alias("f"),
                    F.round("value", 6).alias("value")))


def pad_batches(df: DataFrame, id_col: str, seq_col: str = "seq", batch_size: int = 8,
                shuffle: bool = True, seed=42, out: str = "padded") -> DataFrame:
    """Cut samples into batches of ``batch_size`` (keyed-hash order when
    ``shuffle``, id order otherwise) and right-pad every sequence with zero
    steps to the longest sequence of its batch. Adds ``batch_id``,
    ``n_steps`` and ``out``."""
    from tessera.operators.rank import hash_rank, ordered_rank
    r = hash_rank(df, id_col, seed) if shuffle else ordered_rank(df, id_col)
    r = r.withColumn("batch_id", F.floor((F.col("_rank") - 1) / F.lit(batch_size)).cast("bigint"))
    width = F.size(F.element_at(F.col(seq_col), 1))
    n = F.size(seq_col)
    maxlen = F.max(n).over(W.partitionBy("batch_id"))
    zero_step = F.array_repeat(F.lit(0.0), width)
    padded = F.concat(F.col(seq_col), F.array_repeat(zero_step, maxlen - n))
    return r.withColumn("n_steps", n).withColumn(out, padded).drop("_rank")
