"""Connected components by alternating large-star and small-star rounds.

Every round is a minimum by node (partial sums before the shuffle) and a join
of the edges with those minima. Both sides of the join are plain tables, so
adaptive execution can split a hub that has very many edges. Edges and labels
stay distributed; the driver sees two sums a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _canonical(pairs: DataFrame) -> DataFrame:
    """Distinct (u, v) with v < u."""
    return (pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node of its component.

    Repeated edges, loops and both directions are fine; no edges give no rows.
    """
    now = materialize(_canonical(edges), "edges")
    state = _state(now)
    while state[0]:
        least = materialize(_both(now).groupBy("u").agg(F.min("v").alias("m")), "large-min")
        large = (_both(now).where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")))
        large = materialize(_canonical(large), "large")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "small-min")
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        now = materialize(_canonical(small), "small")
        state, before = _state(now), state
        if state == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
