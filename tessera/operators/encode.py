"""Scaling and encoding.

Fitting returns per-column parameters (O(features) in size); applying them
is one projection that Catalyst folds into the scan's codegen stage.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.missing import number


@dataclass
class ScaleState:
    mean: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)


def fit_scale(df: DataFrame, cols) -> ScaleState:
    """Mean and **population** std per column in one pass; a zero
    variance (or a single row) gives scale 1. Missing values (null, NaN) do
    not count and stay missing (null) when the scale is applied."""
    cols = list(cols)
    if not cols:
        return ScaleState()
    row = df.agg(*[a for i, c in enumerate(cols) for a in (
        F.avg(number(c)).alias(f"m{i}"), F.stddev_pop(number(c)).alias(f"s{i}"))]).first()
    st = ScaleState()
    for i, c in enumerate(cols):
        s = row[f"s{i}"]
        st.mean[c] = row[f"m{i}"] or 0.0
        st.scale[c] = s if s else 1.0
    return st


def scale_expr(c: str, st: ScaleState) -> Column:
    return (number(c) - F.lit(st.mean[c])) / F.lit(st.scale[c])


def apply_scale(df: DataFrame, st: ScaleState) -> DataFrame:
    return df.select(*[scale_expr(c, st).alias(c) if c in st.mean else F.col(c) for c in df.columns])


def fit_categories(df: DataFrame, cols, max_categories: int = 10_000) -> dict:
    """Sorted distinct non-null values per column, from one partial
    ``groupBy(column, value)`` job. A dense encoding wider than
    ``max_categories`` per column is refused rather than silently truncated."""
    from tessera.operators.impute import value_counts
    cols = list(cols)
    vc = value_counts(df, cols, max_categories * max(1, len(cols)))
    big = [c for c in cols if len(vc[c]) > max_categories]
    if big:
        raise ValueError(f"too many categories for a dense encoding (see category_index): {big}")
    return {c: sorted(vc[c]) for c in cols}


@dataclass
class CategoryTable:
    """The categories of a column with too many for a list: (v, idx) in the shared folder, idx from 0 in order of v."""

    path: str
    n: int
    mode: str | None = None     # most frequent value, ties to the smallest

    def frame(self, spark) -> DataFrame:
        return spark.read.schema("v string, idx long").parquet(self.path)

    def code(self, df: DataFrame, value: Column, out: str) -> DataFrame:
        """``df`` and the index of ``value`` as ``out``, null where it is no category. A join of two tables: adaptive
        execution broadcasts the categories where their measured size allows it, and splits a value that very many rows have."""
        table = self.frame(df.sparkSession).select(F.col("v").alias(f"{out}_v"), F.col("idx").alias(out))
        return df.join(table, value == F.col(f"{out}_v"), "left").drop(f"{out}_v")


def category_tables(df: DataFrame, cols, limit: int = 10_000) -> dict:
    """Categories of each column, however many: {value: rows} for up to ``limit`` values, a ``CategoryTable`` beyond.
    One job counts all columns' values (partial counts per task); only the short lists come to the driver."""
    from tessera.operators.rank import ordered_rank
    from tessera.session import written
    cols = list(cols)
    if not cols:
        return {}
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("ci"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)]))
    counts = written(df.select(values.alias("s")).select("s.*").where(F.col("v").isNotNull()).groupBy("ci", "v").agg(F.count(F.lit(1)).alias("k")), "category-counts")
    sizes = {r["ci"]: r["n"] for r in counts.groupBy("ci").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = [i for i in range(len(cols)) if sizes.get(i, 0) <= limit]
    out: dict = {cols[i]: {} for i in few}
    for r in counts.where(F.col("ci").isin(few)).collect():
        out[cols[r["ci"]]][r["v"]] = r["k"]
    for i in sorted(set(range(len(cols))) - set(few)):
        own = counts.where(F.col("ci") == i)
        mode = own.agg(F.min_by("v", F.struct(-F.col("k"), F.col("v")))).first()[0]
        table = written(ordered_rank(own.select("v"), ["v"], out="idx").select("v", (F.col("idx") - 1).alias("idx")), "categories")
        out[cols[i]] = CategoryTable(table.inputFiles()[0].rsplit("/", 1)[0], sizes[i], mode)
    return out


def onehot_exprs(c: str, cats: list) -> list[Column]:
    """D3: one 0/1 column per sorted category; unseen or null → all zeros."""
    x = F.col(c).cast("string")
    return [F.when(x == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{v}") for v in cats]


def category_index(df: DataFrame, cols) -> DataFrame:
    """D3 at any cardinality: (ci, v, idx), the sorted non-null categories of
    the columns, one block of slots a column. It stays a table; no task holds
    all categories of a column."""
    from tessera.operators.rank import ordered_rank
    from tessera.session import written
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("ci"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)]))
    seen = written(df.select(values.alias("s")).select("s.*").where(F.col("v").isNotNull()).distinct(), "categories")
    return written(ordered_rank(seen, ["ci", "v"], out="idx").select("ci", "v", (F.col("idx") - 1).alias("idx")), "category-index")


def onehot_sparse(df: DataFrame, keys, cols, index: DataFrame, out: str = "slots") -> DataFrame:
    """D3 as sparse vectors: keys and the sorted slots that hold a 1. Unseen
    and null categories set none. ``keys`` name a row; rows that share them
    share a result. Both sides of the join are plain tables, so adaptive
    execution can split a category that very many rows have."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("ci"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)]))
    long = df.select(*keys, values.alias("_s")).select(*keys, "_s.ci", "_s.v")
    return long.join(index, ["ci", "v"], "left").groupBy(*keys).agg(F.array_sort(F.collect_set("idx")).alias(out))


def label_code(c: str, classes: list, unseen: str = "error") -> Column:
    """Index in the sorted class list. Unseen → error (default) or -1."""
    x = F.col(c).cast("string")
    idx = (F.array_position(F.array(*[F.lit(v) for v in classes]), x) - 1).cast("double")
    if unseen == "error":
        return F.when(F.coalesce(idx, F.lit(-1.0)) < 0, F.raise_error(F.concat(F.lit(f"unseen label in {c}: "),
                                                       F.coalesce(x, F.lit("null"))))).otherwise(idx)
    return idx


def fit_label_encode(df: DataFrame, cols, max_categories: int = 10_000) -> dict:
    """Sorted classes of each column; a ``CategoryTable`` for more than ``max_categories``."""
    got = category_tables(df, cols, max_categories)
    return {c: v if isinstance(v, CategoryTable) else sorted(v) for c, v in got.items()}


def apply_label_encode(df: DataFrame, classes: dict, unseen: str = "error") -> DataFrame:
    names = df.columns
    for c, table in classes.items():
        if isinstance(table, CategoryTable) and c in names:
            df = table.code(df, F.col(c).cast("string"), f"_code_{c}")

    def one(c):
        if c not in classes:
            return F.col(c)
        if isinstance(classes[c], CategoryTable):
            return table_code(c, f"_code_{c}", unseen).alias(c)
        return label_code(c, classes[c], unseen).alias(c)
    return df.select(*[one(c) for c in names])


def table_code(c: str, idx: str, unseen: str = "error", value: Column | None = None) -> Column:
    """As ``label_code``, from the joined index of a ``CategoryTable``: null stays null, an unseen value is an error or -1."""
    x = F.col(c).cast("string") if value is None else value
    code = F.col(idx).cast("double")
    if unseen == "error":
        return F.when(code.isNull(), F.raise_error(F.concat(F.lit(f"unseen label in {c}: "), F.coalesce(x, F.lit("null"))))).otherwise(code)
    return F.when(x.isNotNull(), F.coalesce(code, F.lit(-1.0)))
