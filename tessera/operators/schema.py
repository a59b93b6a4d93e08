"""Projection, filter and schema alignment.

Helpers that only look at ``df.schema`` run on the driver and start no job;
the rest are lazy relational operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType


def feature_kinds(df: DataFrame, target: str | None = None, exclude=(), policy: str = "tabular"):
    """Numeric and categorical feature names, target/exclusions removed.

    policy ``tabular``: numeric = NumericType (bool is categorical), everything
    else categorical. policy ``series``: categorical = strings only; types that
    are neither (bool, timestamp, ...) belong to no list.
    """
    skip = set(exclude) | ({target} if target else set())
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType):
            num.append(f.name)
        elif policy == "tabular" or isinstance(f.dataType, StringType):
            cat.append(f.name)
    return num, cat


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    """B1: rows whose target is null (or NaN) are dropped; the predicate is
    pushed into the scan."""
    c = F.col(target)
    dt = df.schema[target].dataType
    if dt.typeName() in ("double", "float"):
        return df.where(c.isNotNull() & ~F.isnan(c))
    return df.where(c.isNotNull())


def common_columns(train: DataFrame, test: DataFrame, target: str | None = None, exclude=()):
    """Columns present in both frames, in train's order; the target is
    appended once when train has it (B2). ``exclude`` removes e.g. target/id (B3)."""
    ex = set(exclude)
    tcols = set(test.columns)
    cols = [c for c in train.columns if c in tcols and c not in ex and c != target]
    if target and target in train.columns and target not in ex:
        cols.append(target)
    return cols


def select_common(train: DataFrame, test: DataFrame, target: str | None = None, exclude=()) -> DataFrame:
    return train.select(*common_columns(train, test, target, exclude))


def drop_columns(df: DataFrame, *cols) -> DataFrame:
    """Drop columns, ignoring absent ones."""
    return df.drop(*[c for c in cols if c in df.columns])


def align_columns(df: DataFrame, columns, cat_cols, types: dict | None = None, keep=()) -> DataFrame:
    """Reshape new data to the training schema.

    Missing categorical → constant ``'0'`` (an unseen category, so it encodes
    to all zeros); missing numeric → null (imputed later); extra columns are
    dropped; columns come out in training order. ``keep`` (e.g. the key) is
    carried in front.
    """
    cats = set(cat_cols)
    types = types or {}
    out = [F.col(k) for k in keep]
    for c in columns:
        if c in df.columns:
            out.append(F.col(c))
        elif c in cats:
            out.append(F.lit("0").alias(c))
        else:
            out.append(F.lit(None).cast(types.get(c, "double")).alias(c))
    return df.select(*out)


def restrict_to_available(static: DataFrame, series: DataFrame, id_col: str = "id",
                          check: bool = False) -> DataFrame:
    """Keep subjects that have at least one series row (left-semi join).

    The series side is reduced to its distinct ids first: the partial
    aggregate dedupes map-side, so a subject owning a third of all series
    rows ships one row per task instead of skewing one join partition."""
    out = static.join(series.select(id_col).distinct(), id_col, "left_semi")
    if check and out.isEmpty():
        raise ValueError("no subject of the static table has a series")
    return out


def assemble_samples(static: DataFrame, seq: DataFrame, id_col: str = "id") -> DataFrame:
    """Static row + sequence (+ label) per subject: an inner equi-join."""
    return static.join(seq, id_col, "inner")


def class_counts(df: DataFrame, label: str, by=()) -> DataFrame:
    """Class distribution (``bincount``), optionally per split."""
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))


def num_classes(df: DataFrame, label: str) -> DataFrame:
    """Number of distinct non-null classes."""
    return df.agg(F.countDistinct(label).alias("num_classes"))


def predictions_for(ids: DataFrame, preds: DataFrame, id_col: str = "id",
                    pred_col: str = "prediction", missing: int = -1) -> DataFrame:
    """One prediction per requested id; ids without one get ``-1``."""
    p = preds.select(id_col, pred_col)
    return (ids.select(id_col).join(p, id_col, "left")
            .select(id_col, F.coalesce(F.col(pred_col), F.lit(missing)).cast("int").alias(pred_col)))
