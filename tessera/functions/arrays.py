"""Array (vector) expressions that stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_zero(arr: Column) -> Column:
    return F.transform(arr, lambda x: F.when(F.isnan(x) | x.isNull(), F.lit(0.0)).otherwise(x))


def softmax(logits: Column, n: int | None = None) -> Column:
    """Numerically stable softmax of an array<double> column. With a known
    width ``n`` it is written element by element (whole-stage codegen);
    otherwise with array lambdas."""
    if n:
        xs = [logits.getItem(i) for i in range(n)]
        m = F.greatest(*xs) if n > 1 else xs[0]
        es = [F.exp(x - m) for x in xs]
        tot = sum(es[1:], es[0])
        return F.array(*[e / tot for e in es])
    m = F.array_max(logits)
    ex = F.transform(logits, lambda x: F.exp(x - m))
    total = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: x / total)


def argmax(arr: Column) -> Column:
    """0-based index of the first maximum (ties resolve to the first)."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def nan_to_zero_n(arr: Column, n: int) -> Column:
    return F.array(*[F.when(F.isnan(arr.getItem(i)) | arr.getItem(i).isNull(), F.lit(0.0))
                     .otherwise(arr.getItem(i)) for i in range(n)])


def pick(arr: Column, idx: list[int]) -> Column:
    """Project an array onto the given 0-based positions."""
    return F.array(*[arr.getItem(i) for i in idx]) if idx else F.array().cast("array<double>")


def axpy(x: Column, y: Column, u: Column) -> Column:
    """x + u * (y - x), element-wise."""
    return F.zip_with(x, y, lambda a, b: a + u * (b - a))
