"""Keyed, partition-independent randomness.

Every seeded step (sampling, splitting, shuffling into batches, synthetic
rows) orders or draws by ``md5(seed ':' key...)``. The value depends only on
the row's key, never on partitioning, task retries or executor loss, so a
recomputed partition yields the same rows, and the same rule is one line of
SQL in any engine that has md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _parts(seed, keys) -> list[Column]:
    cols = [F.lit(str(seed))]
    for k in keys:
        c = F.col(k) if isinstance(k, str) else k
        cols.append(c.cast("string"))
    return cols


def keyed_md5(seed, *keys) -> Column:
    """md5 hex of ``seed:key1:key2...``."""
    return F.md5(F.concat_ws(":", *_parts(seed, keys)))


def keyed_hash60(seed, *keys) -> Column:
    """First 15 hex digits of the keyed md5 as a non-negative bigint (60 bits).

    Sorting by it is sorting by the md5 string; a long sorts cheaper.
    """
    return F.conv(F.substring(keyed_md5(seed, *keys), 1, 15), 16, 10).cast("bigint")


def keyed_uniform(seed, *keys) -> Column:
    """Uniform double in [0, 1): first 8 hex digits / 2^32."""
    return F.conv(F.substring(keyed_md5(seed, *keys), 1, 8), 16, 10).cast("bigint") / F.lit(TWO_32)


def keyed_index(seed, n: Column | int, *keys) -> Column:
    """Integer in [0, n) drawn from the keyed hash (bootstrap index)."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.pmod(keyed_hash60(seed, *keys), n.cast("bigint"))
