"""Ordered chunks as a function of the row.

Range partitioning samples its bounds anew in every exchange, so a chunk that
is "the partition a row came to" differs between two branches of a plan unless
Spark happens to reuse one exchange. Here the bounds are drawn once, by a keyed
hash, and become literals of the plan: every branch that has the key columns
computes the same chunk by a binary search, whatever else it reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType, TimestampNTZType, TimestampType

#: Sampled rows for each chunk: what the driver fetches is about ``chunks`` times that.
SAMPLE = 64
#: Bounds that are compared by generated code; more are searched in a literal array.
COMPARED = 200
#: Parts of the hash range that a sample is cut from.
HASHES = 1 << 40


def order_key(df: DataFrame, cols) -> list[Column]:
    """Key columns in a form whose literals compare as the column does (time stamps: microseconds)."""
    def one(c):
        kind = df.schema[c].dataType
        if isinstance(kind, TimestampType):
            return F.unix_micros(F.col(f"`{c}`"))
        if isinstance(kind, TimestampNTZType):
            return F.unix_micros(F.col(f"`{c}`").cast("timestamp"))
        return F.col(f"`{c}`")
    return [one(c) for c in cols]


def chunk_column(df: DataFrame, cols, chunks: int, seed: str = "chunk") -> Column:
    """0-based chunk of each row, ascending with ``cols`` (nulls first).

    The sample holds the rows whose key's hash is below a share of the range
    (each task sends its own part of it), so it does not depend on
    partitioning; a repeated run gets the same bounds. Bounds only balance the
    chunks: any bounds give the same final result.
    """
    if chunks < 2:
        return F.lit(0)
    key = order_key(df, cols)
    names = [f"_k{i}" for i in range(len(key))]
    keyed = df.select(*[k.alias(n) for k, n in zip(key, names)])
    rows, wanted = keyed.count(), chunks * SAMPLE
    if rows > wanted:
        keyed = keyed.where(F.pmod(F.xxhash64(F.lit(seed), *names), F.lit(HASHES)) < F.lit(int(wanted / rows * HASHES)))
    sample = [tuple(r) for r in keyed.distinct().orderBy(*names).collect() if not any(v is None for v in r)]
    bounds = sorted_distinct([sample[len(sample) * i // chunks] for i in range(1, chunks)] if sample else [])
    here = F.struct(*[k.alias(n) for k, n in zip(key, names)])
    return (compare(here, bounds, keyed.schema) if len(bounds) <= COMPARED else search(here, bounds, keyed.schema)) if bounds else F.lit(0)


def compare(here: Column, bounds: list, schema: StructType) -> Column:
    """As ``search``, by nested conditions, which are generated code; too many of them would not fit into a method."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        bound = F.struct(*[F.lit(v).cast(f.dataType) for v, f in zip(bounds[mid], schema)])
        return F.when(here < bound, tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(bounds))


def literal(value, kind: DataType) -> str:
    """SQL text of a value; texts and bytes by their bytes, so that nothing needs to be escaped."""
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    text = f"CAST(X'{value.encode().hex()}' AS STRING)" if isinstance(value, str) else f"'{value}'"
    return f"CAST({text} AS {kind.simpleString()})"


def search(here: Column, bounds: list, schema: StructType) -> Column:
    """How many of the ascending ``bounds`` are not above ``here``: a binary search in one literal array."""
    rows = (", ".join(f"'{f.name}', {literal(v, f.dataType)}" for v, f in zip(b, schema)) for b in bounds)
    table = F.expr(f"array({', '.join(f'named_struct({r})' for r in rows)})")  # folded to one literal when planned
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = here < F.element_at(table, F.least(mid + 1, F.lit(len(bounds))))
        go = s["lo"] < s["hi"]
        return F.struct(F.when(go & ~below, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(go & below, mid).otherwise(s["hi"]).alias("hi"))

    return F.aggregate(steps, start, halve, lambda s: s["lo"])


def sorted_distinct(rows: list) -> list:
    """Rows that are in order already, without repeats."""
    return [r for i, r in enumerate(rows) if i == 0 or r != rows[i - 1]]
