"""Nearest-neighbour imputation (C3) and SMOTE (G4) on the exact block index.

Searches go through ``operators.neighbours``: leaves of median splits,
lower bounds by boxes, the k best of a block leaving it. The imputation of two
columns, whose vectors are numbers, goes through ``operators.line``, that of more
through ``operators.tiles``. Ties order by (distance, donor key).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import line, neighbours, tiles
from tessera.operators.impute import normalize_nan
from tessera.session import written


def exact_knn(queries: DataFrame, donors: DataFrame, qkey: str, dkey: str, vec: str = "vec", k: int = 5,
              part=(), exclude_self: bool = False, scale: float = 1.0, stats: dict | None = None, **sizes) -> DataFrame:
    """(part…, qkey, dkey, nn_rank, dist) for the k nearest donors of every
    query (fewer when fewer donors exist). ``vec`` is a complete
    array<double> in both frames; ``part`` restricts neighbours to the same
    partition values (e.g. the class)."""
    part = list(part)
    one = donors.select(F.size(vec)).limit(1).collect()
    if not one:
        cols = [f"{p} {queries.schema[p].dataType.simpleString()}" for p in part]
        cols += [f"{qkey} {queries.schema[qkey].dataType.simpleString()}",
                 f"{dkey} {donors.schema[dkey].dataType.simpleString()}", "nn_rank int", "dist double"]
        return queries.sparkSession.createDataFrame([], ", ".join(cols))
    return neighbours.search(queries, donors, qkey, dkey, vec, k, one[0][0], part, exclude_self, None, scale, stats, **sizes)


def nan_knn(queries: DataFrame, donors: DataFrame, qkey: str, dkey: str, p: int, width: int, vec: str = "vec", k: int = 5,
            stats: dict | None = None, **sizes) -> DataFrame:
    """(qkey, dkey, nn_rank, dist): the k nearest donors of every query by the
    nan-Euclidean distance sqrt(p / |common| · Σ_common (a − b)²) of vectors
    with ``width`` coordinates, any of which may be null. One search whatever
    the missing-value patterns."""
    return neighbours.search(queries, donors, qkey, dkey, vec, k, width, p=p, stats=stats, **sizes)


def knn_impute(df: DataFrame, key: str, cols, k: int = 5, donors: DataFrame | None = None, means: dict | None = None) -> DataFrame:
    """Every missing numeric value ← mean of that column over the k
    nearest rows having it, by nan-Euclidean distance over the other columns
    present in both (p = all columns); column mean when no row shares a present
    column. Distances use the original (unimputed) values for every column. One
    search for all columns, whatever the patterns of missing values.

    ``donors`` (default: ``df`` itself) are the fitted rows, e.g. the
    training table when new rows are transformed; ``means`` their column
    means (computed when not given)."""
    cols = list(cols)
    same = donors is None or donors is df
    df = normalize_nan(df, cols)
    if set(df.columns) <= {key, *cols}:  # else the columns of the search alone are written, by ``fills``
        df = written(df, "rows")
    return filled(df, key, cols, *fills(df, key, cols, k, None if same else donors, means))


def fills(df: DataFrame, key: str, cols, k: int = 5, donors: DataFrame | None = None, means: dict | None = None) -> tuple[DataFrame | None, dict]:
    """What ``knn_impute`` puts in place of missing values: a row (key, ``_imp_`` of the columns) for each key that gets
    any, found and written once, and the column means. NaN in ``df`` must be null."""
    cols = list(cols)
    rows = df if set(df.columns) <= {key, *cols} else written(df.select(key, *cols), "rows")
    given = None if donors is None else normalize_nan(donors, cols).select(key, *cols)
    if means is None:
        row = (rows if given is None else given).agg(*[F.avg(c).alias(c) for c in cols]).first()
        means = {c: row[c] for c in cols}
    if len(cols) < 2:
        return None, means
    if not any(isinstance(rows.schema[c].dataType, T.DecimalType) for c in cols):
        found = (line if len(cols) == 2 else tiles).fills(rows, key, cols, k, given)
        if found is not None:
            return written(found, "fills"), means
    out = None
    for t in cols:
        others = [c for c in cols if c != t]
        vec = F.array(*[F.col(c).cast("double") for c in others]).alias("vec")
        some = F.coalesce(*[F.col(c).cast("double") for c in others]).isNotNull()
        rec = rows.where(F.col(t).isNull() & some).select(key, vec)
        don = (rows if given is None else given).where(F.col(t).isNotNull() & some).select(F.col(key).alias("_dk"), F.col(t).alias("_tv"), vec)
        best = nan_knn(rec, don, key, "_dk", len(cols), len(others), "vec", k)
        vals = best.join(don.select("_dk", "_tv"), "_dk").groupBy(key).agg(F.avg("_tv").alias("_v"))
        vals = vals.select(key, *[(F.col("_v") if c == t else F.lit(None)).cast("double").alias(f"_imp_{c}") for c in cols])
        out = vals if out is None else out.unionByName(vals)
    return written(out.groupBy(key).agg(*[F.max(f"_imp_{c}").alias(f"_imp_{c}") for c in cols]), "fills"), means


def filled(df: DataFrame, key: str, cols, vals: DataFrame | None, means: dict) -> DataFrame:
    """``df`` with the values of ``fills`` in place of missing ones; only rows that lack one are joined."""
    def put(rows: DataFrame, of) -> DataFrame:
        return rows.select(*[of(c).alias(c) if c in cols else F.col(c) for c in df.columns])

    value = lambda c: F.col(c).cast("double")
    if vals is None:
        return put(df, lambda c: F.coalesce(value(c), F.lit(means[c])))
    lacks = reduce(or_, [F.col(c).isNull() for c in cols])
    joined = df.where(lacks).join(vals, key, "left")
    return put(df.where(~lacks), value).unionByName(put(joined, lambda c: F.coalesce(value(c), F.col(f"_imp_{c}"), F.lit(means[c]))))


def smote(df: DataFrame, label: str, key: str, vec: str = "features", k: int = 5, seed=42) -> DataFrame:
    """Every class grown to the majority count with synthetic rows
    x + u·(nn − x): draw i of class c takes the base row of keyed rank
    md5(seed:c:i:b) mod n_c, its neighbour slot md5(seed:c:i:n) mod k among
    the k nearest same-class rows (self excluded), u = uniform(seed:c:i:u).
    Output: originals (``synthetic`` = -1) and draws (``synthetic`` = i)."""
    from tessera.functions.keys import keyed_index, keyed_uniform
    from tessera.operators.balance import deficits, draws
    from tessera.operators.rank import hash_rank
    df = df.where(F.col(label).isNotNull()).select(key, label, vec)
    need = deficits(df, label)
    orig = df.withColumn("synthetic", F.lit(-1).cast("bigint"))
    if need.isEmpty():
        return orig
    minority = df.join(need.select(label), label, "left_semi")
    drawn = draws(need, label).select(
        label, "i", (keyed_index(seed, F.col("n_c"), F.col(label), F.col("i"), F.lit("b")) + 1).alias("_rank"),
        keyed_uniform(seed, F.col(label), F.col("i"), F.lit("u")).alias("_u"))
    ranked = hash_rank(minority, key, seed, group=[label])
    # neighbours only of the rows that are drawn as a base
    bases = drawn.join(ranked, [label, "_rank"]).select(key, label, vec, "i", "_u")
    wanted = bases.select(key, label, vec).dropDuplicates([label, key])
    nn = exact_knn(wanted, minority.withColumnRenamed(key, "_nn"), key, "_nn", vec, k, part=[label], exclude_self=True)
    kk = nn.groupBy(label, key).agg(F.count(F.lit(1)).alias("_kn"))
    base = bases.join(kk, [label, key])
    base = base.withColumn("nn_rank", (keyed_index(seed, F.col("_kn"), F.col(label), F.col("i"), F.lit("n")) + 1)
                           .cast("int"))
    pair = base.join(nn.select(label, key, "nn_rank", "_nn"), [label, key, "nn_rank"])
    other = minority.select(F.col(key).alias("_nn"), F.col(vec).alias("_nv"))
    syn = pair.join(other, "_nn").select(
        F.col(key), label,
        F.zip_with(F.col(vec), F.col("_nv"), lambda a, b: a + F.col("_u") * (b - a)).alias(vec),
        F.col("i").alias("synthetic"))
    return orig.unionByName(syn.select(key, label, vec, "synthetic"))
