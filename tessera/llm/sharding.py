"""Byte-balanced shards by histogram sort.

Rows are ordered by a 64-bit key. Splitters start as coarse probes; each round
counts the exact bytes below every probe in all partitions and narrows the
interval of each splitter until it meets the tolerance. The rounds read sizes and
keys only. Then the whole rows, texts and all other columns, are exchanged once
and written, a folder for each shard.

The key's high 40 bits are a hash of the text and its low 24 bits one of the
id. Copies of a text are neighbours, and a splitter falls between two texts
wherever the tolerance allows it; a group of copies too large for that is cut
inside by the low bits, so that no shard has to hold all of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import free_name, materialize, shared_path

LOW_BITS = 24
GROUP = 1 << LOW_BITS
KEY_MIN, KEY_END = -(1 << 63), 1 << 63
#: Probes of one round, over all splitters: what a round sends to the driver.
PROBES = 16_384


def _size(text: Column, overhead: int) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + overhead


def _key(row_id: Column, text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(-GROUP)).bitwiseOR(F.xxhash64(row_id).bitwiseAND(F.lit(GROUP - 1)))


def below(keyed: DataFrame, probes: np.ndarray) -> list[tuple[int, int]]:
    """Exact (bytes, rows) with a key below each probe: partial counts by partition, then one sum a bin."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for b in batches:
            at = np.searchsorted(probes, b.column("key").to_numpy(), side="right")
            np.add.at(size, at, b.column("size").to_numpy())
            np.add.at(rows, at, 1)
        has = np.nonzero(rows)[0]
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(size[has]), pa.array(rows[has])], names=["bin", "size", "n"])

    found = (keyed.select("key", "size").mapInArrow(count, "bin long, size long, n long")
             .groupBy("bin").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect())
    size, rows = [0] * (len(probes) + 1), [0] * (len(probes) + 1)
    for r in found:
        size[r["bin"]], rows[r["bin"]] = r["size"], r["n"]
    out, s, n = [], 0, 0
    for i in range(len(probes)):
        s, n = s + size[i], n + rows[i]
        out.append((s, n))
    return out


def _probes(lo: int, hi: int, n: int) -> list[int]:
    """Up to ``n`` keys strictly between lo and hi, between two texts as long as the interval has such a place."""
    first = -(-(lo + 1) // GROUP) * GROUP
    if first < hi:
        step = max(GROUP, (hi - lo) // (n + 1) // GROUP * GROUP)
        return list(range(first, hi, step))[: n + 1]
    step = max(1, (hi - lo) // (n + 1))
    return list(range(lo + step, hi, step))[: n + 1]


def find_splitters(keyed: DataFrame, n: int, total: tuple[int, int], tolerance: float) -> list[tuple[int, int]]:
    """n - 1 (key, rows below it), each within ``tolerance`` of a share from its place, or the nearest one there is."""
    share = total[0] / n
    # interval of each splitter: (key, bytes below, rows below) at both ends
    open_ = {i: ((KEY_MIN, 0, 0), (KEY_END, *total)) for i in range(1, n)}
    done: dict[int, tuple[int, int]] = {}
    while open_:
        spans = {(a[0], b[0]) for a, b in open_.values()}
        each = max(3, min(255, PROBES // len(spans)))
        probes = sorted({p for lo, hi in spans for p in _probes(lo, hi, each)})
        known = list(zip(probes, below(keyed, np.array(probes, np.int64)))) if probes else []
        keys = np.array(probes, dtype=object)
        for i, (a, b) in list(open_.items()):
            want = i * share
            for k, (s, r) in known[np.searchsorted(keys, a[0], "right"):np.searchsorted(keys, b[0], "left")]:
                if s <= want:
                    a = (k, s, r)
                else:
                    b = (k, s, r)
                    break
            near = min(a, b, key=lambda x: abs(x[1] - want))
            if abs(near[1] - want) <= tolerance * share or b[2] - a[2] <= 1 or b[0] - a[0] <= 1:
                done[i] = (near[0], near[2])
                del open_[i]
            else:
                open_[i] = (a, b)
    return [done[i] for i in range(1, n)]


def shard_rows(df: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.005,
               rows_a_range: int = 1 << 20, bytes_a_range: int = 1 << 28, overhead: int = 16) -> DataFrame:
    """``df``, sharded and written: all columns, and shard and slot. Shards have near equal bytes, slots are gapless from 0.

    A row's size is its text in UTF-8 and ``overhead``. A shard is one or more
    key ranges of about ``rows_a_range`` rows or ``bytes_a_range`` bytes; a
    range is what one task sorts. Null ids and texts hash like any other value,
    repeated rows are placed each, an empty table gives an empty one. Fewer
    rows than shards leave shards empty. Input columns named shard or slot are
    replaced. ``df`` is read twice and must give the same rows.
    """
    names = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    row_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    keyed = materialize(df.select(_size(text, overhead).alias("size"), _key(row_id, text).alias("key")), "shard-keys")
    rows, size = keyed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    a_shard = max(1, math.ceil(rows / n_shards / rows_a_range), math.ceil(size / n_shards / bytes_a_range))
    found = find_splitters(keyed, n_shards * a_shard, (size, rows), tolerance) if rows else []
    # a key of KEY_END stands above all rows
    splitters = np.array([min(k, KEY_END - 1) for k, _ in found], np.int64)
    starts = np.array([0, *(r for _, r in found)], np.int64)
    base = starts - np.repeat(starts[::a_shard], a_shard)[: len(starts)] if rows else starts

    # only keys go to Python, the rows stay where they are
    @F.arrow_udf("struct<range: int, shard: int, base: long>")
    def place(keys: pa.Array) -> pa.Array:
        at = np.searchsorted(splitters, keys.to_numpy(zero_copy_only=False), side="right")
        return pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array((at // a_shard).astype(np.int32)), pa.array(base[at])],
                                          names=["range", "shard", "base"])

    key, to = free_name(df, "_key"), free_name(df, "_to")
    placed = df.withColumn(key, _key(row_id, text)).withColumn(to, place(F.col(key)))
    # the shard comes first, so that the order serves the writer too
    order = Window.partitionBy(f"{to}.shard", f"{to}.range").orderBy(key, row_id, text)
    out = placed.select(*[F.col(f"`{c}`") for c in names], F.col(f"{to}.shard").alias("shard"),
                        (F.col(f"{to}.base") + F.row_number().over(order) - 1).alias("slot"))
    path = shared_path(df.sparkSession, "shards")
    out.write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path).select(*[f"`{c}`" for c in out.columns])


def shard_by_bytes(df: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                   tolerance: float = 0.005, rows_a_range: int = 1 << 20) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: digests of the rows that ``shard_rows`` wrote, from their texts."""
    text, overhead = F.col(f"`{text_col}`").cast("string"), 16
    return shard_rows(df, n_shards, id_col, text_col, tolerance, rows_a_range, overhead=overhead).select(
        F.col(f"`{id_col}`").alias("doc_id"), _size(text, overhead).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), "shard", "slot")
