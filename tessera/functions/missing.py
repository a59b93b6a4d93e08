"""One rule for what is missing: null, and NaN in floating-point columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def number(c: str | Column) -> Column:
    """A numeric column as double, NaN as null."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def present(c: str, kind: DataType) -> Column:
    """The column in its own type, NaN as null."""
    return F.nanvl(F.col(c), F.lit(None).cast(kind)) if isinstance(kind, (DoubleType, FloatType)) else F.col(c)
