"""Missing-value imputation.

Fitting runs a fixed, small number of aggregate jobs over all columns at
once and returns a driver-sized state (one value per column). Applying the
state is a narrow ``coalesce`` projection: no shuffle, no join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.missing import present


def normalize_nan(df: DataFrame, cols) -> DataFrame:
    """Incoming NaN counts as missing: NaN → null for float columns."""
    return df.select(*[present(f.name, f.dataType).alias(f.name) if f.name in cols else F.col(f.name)
                       for f in df.schema.fields])


def bracket_aggs(cols, q: float = 0.5, accuracy: int = 10000, prefix: str = "_q"):
    """Aggregate expressions of the first quantile pass (count and an
    approximate bracket around the target rank); callers may fold them into
    another aggregate over the same rows."""
    eps = 1.0 / accuracy
    lo_p, hi_p = max(0.0, q - 2 * eps), min(1.0, q + 2 * eps)
    out = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        out += [F.count(x).alias(f"{prefix}n{i}"),
                F.percentile_approx(x, F.array(F.lit(lo_p), F.lit(hi_p)), accuracy).alias(f"{prefix}b{i}")]
    return out


def exact_quantiles(df: DataFrame, cols, q: float = 0.5, accuracy: int = 10000,
                    max_collect: int = 200_000, first=None, prefix: str = "_q",
                    cat_cols=(), cat_limit: int = 0, cat_out: dict | None = None) -> dict:
    """Exact linear-interpolated quantile of many columns, distributed.

    A global exact percentile would merge every distinct value of a column
    in one task. Instead: (1) ``percentile_approx`` brackets the target
    ranks (rank error ≤ n/accuracy); (2) one job counts, per column, the rows
    below the bracket and the rows per distinct value inside it (values below
    / above collapse to two sentinel groups), fetching at most
    ``max_collect`` groups; (3) a bracket holding more distinct values is
    narrowed by another approximate pass over its rows only. Only bounded
    histograms reach the driver. Result per column: value or None (no data).
    ``first`` is a Row already holding the ``bracket_aggs`` results.
    ``cat_cols``: value counts of these columns ride along in the first
    histogram job (written into ``cat_out``), saving a scan; where they are more than ``cat_limit``, ``cat_out`` stays without them.
    """
    cols = list(cols)
    cat_cols = list(cat_cols)
    if not cols:
        if cat_cols and cat_out is not None:
            cat_out.update(counts_if_few(df, cat_cols, cat_limit))
        return {}
    eps = 1.0 / accuracy
    xs = {c: F.col(c).cast("double") for c in cols}
    if first is None:
        first = df.agg(*bracket_aggs(cols, q, accuracy, prefix)).first()
    st = {}
    for i, c in enumerate(cols):
        n = first[f"{prefix}n{i}"]
        if not n:
            continue
        pos = q * (n - 1)
        b = first[f"{prefix}b{i}"]
        st[c] = dict(n=n, pos=pos, r1=math.floor(pos), r2=math.ceil(pos),
                     lo=None if q - 2 * eps <= 0 else b[0], hi=None if q + 2 * eps >= 1 else b[1])
    result = {c: None for c in cols}
    NEG, POS = float("-inf"), float("inf")

    def bucket(c):
        s, x = st[c], xs[c]
        e = x
        if s["hi"] is not None:
            e = F.when(x > F.lit(s["hi"]), F.lit(POS)).otherwise(e)
        if s["lo"] is not None:
            e = F.when(x < F.lit(s["lo"]), F.lit(NEG)).otherwise(e)
        return e

    def inside(c):
        s, x = st[c], xs[c]
        cond = x.isNotNull()
        if s["lo"] is not None:
            cond = cond & (x >= F.lit(s["lo"]))
        if s["hi"] is not None:
            cond = cond & (x <= F.lit(s["hi"]))
        return cond

    todo = list(st)
    ride = list(cat_cols) if cat_out is not None else []
    if ride and not todo:
        cat_out.update(counts_if_few(df, ride, cat_limit))
        ride = []
    while todo:    # each round fixes a column or narrows its bracket
        nt = len(todo)
        structs = [F.struct(F.lit(j).alias("ci"), bucket(c).alias("v"), F.lit(None).cast("string").alias("t"))
                   for j, c in enumerate(todo)]
        structs += [F.struct(F.lit(nt + j).alias("ci"), F.lit(None).cast("double").alias("v"),
                             F.col(c).cast("string").alias("t")) for j, c in enumerate(ride)]
        long = df.select(F.explode(F.array(*structs)).alias("s")).select("s.*") \
            .where(F.col("v").isNotNull() | F.col("t").isNotNull())
        cap = max_collect + 2 * nt + (cat_limit if ride else 0)
        hist_rows = long.groupBy("ci", "v", "t").count().limit(cap + 1).collect()
        complete = len(hist_rows) <= cap
        hist = {}
        for r in hist_rows:
            if r["ci"] < nt:
                hist.setdefault(r["ci"], []).append((r["v"], r["count"]))
        if ride:
            if complete:
                got = {c: {} for c in ride}
                for r in hist_rows:
                    if r["ci"] >= nt:
                        got[ride[r["ci"] - nt]][r["t"]] = r["count"]
                cat_out.update(got)
            else:   # cannot tell which part overflowed: count categories on their own
                cat_out.update(counts_if_few(df, ride, cat_limit))
            ride = []
        refine, nxt = [], []
        for j, c in enumerate(todo):
            s = st[c]
            vals = sorted(hist.get(j, []))
            below = sum(k for v, k in vals if v == NEG)
            mid = [(v, k) for v, k in vals if v not in (NEG, POS)]
            inside_n = s["n"] - below - sum(k for v, k in vals if v == POS) if complete else None
            ok = True
            if complete:
                if below > s["r1"]:
                    s["lo"], ok = None, False
                if below + inside_n <= s["r2"]:
                    s["hi"], ok = None, False
            if not ok:
                nxt.append(c)  # widened: recount next round
                continue
            if not complete:
                refine.append(c)
                continue

            def at(rank, below=below, mid=mid):
                acc = below
                for v, k in mid:
                    acc += k
                    if acc > rank:
                        return v
                raise AssertionError("rank outside bracket")
            v1, v2 = at(s["r1"]), at(s["r2"])
            result[c] = v1 + (s["pos"] - s["r1"]) * (v2 - v1)
        if refine:
            cnt = df.agg(*[a for i, c in enumerate(refine) for a in (
                F.sum(F.when(xs[c] < F.lit(st[c]["lo"]) if st[c]["lo"] is not None else F.lit(False), 1)
                      .otherwise(0)).alias(f"lo{i}"),
                F.sum(F.when(inside(c), 1).otherwise(0)).alias(f"in{i}"))]).first()
            aggs = []
            for i, c in enumerate(refine):
                s = st[c]
                s["below"], m = cnt[f"lo{i}"] or 0, max(cnt[f"in{i}"] or 1, 1)
                p1 = max(0.0, (s["r1"] - s["below"]) / m - 2 * eps)
                p2 = min(1.0, (s["r2"] - s["below"] + 1) / m + 2 * eps)
                aggs.append(F.percentile_approx(F.when(inside(c), xs[c]), F.array(F.lit(p1), F.lit(p2)),
                                                accuracy).alias(f"b{i}"))
            nb = df.agg(*aggs).first()
            for i, c in enumerate(refine):
                s = st[c]
                lo, hi = nb[f"b{i}"]
                s["lo"] = lo if s["lo"] is None else max(s["lo"], lo)
                s["hi"] = hi if s["hi"] is None else min(s["hi"], hi)
            nxt += refine
        todo = nxt
    return result


class TooManyCategories(ValueError):
    """More distinct values than were to be fetched; ``encode.category_tables`` takes any number."""


def counts_if_few(df: DataFrame, cols, limit: int) -> dict:
    """``value_counts``, or nothing where there are more than ``limit``."""
    try:
        return value_counts(df, cols, limit)
    except TooManyCategories:
        return {}


def value_counts(df: DataFrame, cols, limit: int) -> dict:
    """Distinct non-null values with counts for many columns in one job
    (partial counts per task). At most ``limit`` groups are fetched; more
    raises instead of truncating."""
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("ci"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)
    ])).alias("s")).select("s.*").where(F.col("v").isNotNull())
    rows = long.groupBy("ci", "v").agg(F.count(F.lit(1)).alias("k")).limit(limit + 1).collect()
    if len(rows) > limit:
        raise TooManyCategories(f"more than {limit} distinct categorical values; use a sparse encoding")
    out = {c: {} for c in cols}
    for r in rows:
        out[cols[r["ci"]]][r["v"]] = r["k"]
    return out


def most_frequent(df: DataFrame, cols) -> dict:
    """Mode of many columns at once; ties go to the smallest value.

    Long format (column, value) → partial count per task → per-column
    ``min_by(value, (-count, value))``. A hot value (a third of all rows) is
    combined map-side, so no task sees more than its share.
    """
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("ci"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)
    ])).alias("s")).select("s.*").where(F.col("v").isNotNull())
    best = (long.groupBy("ci", "v").agg(F.count(F.lit(1)).alias("k"))
            .groupBy("ci").agg(F.min_by("v", F.struct(-F.col("k"), F.col("v"))).alias("mode")))
    got = {r["ci"]: r["mode"] for r in best.collect()}
    return {c: got.get(i) for i, c in enumerate(cols)}


@dataclass
class ImputeState:
    strategy: str
    fills: dict = field(default_factory=dict)      # column -> fill value
    dropped: list = field(default_factory=list)    # all-missing columns (C6)
    types: dict = field(default_factory=dict)      # column -> Spark SQL type name


def fit_impute(df: DataFrame, cols, strategy: str = "median", **kw) -> ImputeState:
    """C1 median / C2 mean / C4 most_frequent / C5 constant ``Unknown``.

    Columns that are entirely missing get no fill and are recorded as
    dropped, as the library imputers do by default.
    """
    cols = list(cols)
    types = {c: df.schema[c].dataType.simpleString() for c in cols}
    df = normalize_nan(df, cols)
    if strategy == "mean":
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first() if cols else {}
        fills = {c: row[f"m{i}"] for i, c in enumerate(cols)}
    elif strategy == "median":
        fills = exact_quantiles(df, cols, 0.5, **kw)
    elif strategy == "most_frequent":
        fills = most_frequent(df, cols)
    elif strategy == "constant":
        fills = {c: kw.get("fill_value", "Unknown") for c in cols}
    else:
        raise ValueError(f"unsupported imputation method: {strategy}")
    dropped = [c for c in cols if fills.get(c) is None]
    return ImputeState(strategy, {c: v for c, v in fills.items() if v is not None}, dropped, types)


def apply_impute(df: DataFrame, state: ImputeState) -> DataFrame:
    """Narrow projection: ``coalesce(c, fill)``; dropped columns removed."""
    out = []
    for c in df.columns:
        if c in state.dropped:
            continue
        if c in state.fills:
            v = state.fills[c]
            t = state.types.get(c) or df.schema[c].dataType.simpleString()
            fill = F.lit(v).cast(t) if state.strategy in ("most_frequent",) else F.lit(v)
            out.append(F.coalesce(present(c, df.schema[c].dataType), fill).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def fill_unknown(df: DataFrame, cols, value: str = "Unknown") -> DataFrame:
    """Missing categorical → constant."""
    return df.select(*[F.coalesce(F.col(c), F.lit(value)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])
