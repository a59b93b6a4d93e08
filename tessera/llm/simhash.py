"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into two segments of 32 bits. Two fingerprints at
most two bits apart differ by at most one bit in some segment. Each distinct
fingerprint is entered once in each segment's table, under the value of that
segment; it looks up the small Hamming ball around its own value there (33
values), and what it meets is a candidate whose complete distance is verified.

A segment value that very many fingerprints share (near copies by the
thousand) would meet all its pairs. Fingerprints of a crowded value, and those
whose ball touches one, take the other segment as a second key: they enter
under themselves and under each of the 64 fingerprints one bit away. Such an
entry z holds 65 fingerprints at most, so it is kept as a bit set (which bits
are flipped) that partial sums build before the shuffle, and it is linked as a
star from its first member, never as all pairs. Two fingerprints that the
tables do not bring together both are of this kind, so no link is lost.
Copies are folded into their fingerprint beforehand.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_struct, materialize
from tessera.llm.graph import components

_LANES = np.arange(8, dtype=np.int32) * 256
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
FINGERPRINT = T.StructType([T.StructField("value", T.LongType())])
#: Shingles hashed at a time: a very long text is summed in parts.
PART = 1 << 16
#: Fingerprints that an entry of a segment's table holds; a value of more is crowded and takes the second key.
CROWD = 64


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of a whole text: bit set if set in over half of its shingles' XXH64 (seed 42)."""
    import xxhash

    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(2048, np.int64)
    for at in range(0, n, PART):
        part = words[at:at + PART + shingle - 1]
        each = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        raw = np.frombuffer(b"".join(map(xxhash.xxh64_digest, each, repeat(42))), np.uint8).reshape(-1, 8)
        counts += np.bincount((raw + _LANES).ravel(), minlength=2048)
    ones = (counts.reshape(8, 256) @ _BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprint(df: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "simhash",
                     keep: list[str] | None = None) -> DataFrame:
    """``df`` and the struct ``out`` with ``value``, the fingerprint as a signed long. No words: zero."""
    def make(texts: list) -> dict[str, list]:
        return {"value": [v - (1 << 64) if (v := fingerprint(t, shingle)) >> 63 else v for t in texts]}

    return add_struct(df, text_col, out, FINGERPRINT, make, keep=keep)


def links(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """(u, v): verified links that join all of ``fps`` (distinct, column fp) at most ``max_distance`` bits apart.

    All pairs that the segment tables bring together; for crowded values one
    star for each entry, through which the pairs within reach are connected.
    ``max_distance`` is 0 to 2, the reach of radius one in two segments.
    """
    if not 0 <= max_distance <= 2:
        raise ValueError("two segments with balls of radius one reach 0 to 2 bits")
    # the few columns read would be few tasks: dealt out first, each one's partial sums stay small
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.explode(F.expr("array(fp & 4294967295L, shiftrightunsigned(fp, 32) | 4294967296L)")).alias("key")  # bit 32: which segment
    entries = materialize(fps.select("fp").repartition(n).select("fp", own), "segments")
    crowded = materialize(entries.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("key"), "crowded")
    any_crowded = not crowded.isEmpty()
    light = materialize(entries.join(crowded, "key", "left_anti"), "light-segments") if any_crowded else entries
    found = candidates(light, max_distance).where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_distance)
    if not any_crowded:
        return found
    touching = _probes(light, max_distance).join(crowded, F.col("z") == F.col("key"), "left_semi").select("fp")
    second = materialize(entries.join(crowded, "key", "left_semi").select("fp").union(touching).distinct(), "second-key")
    return found.union(_stars(second, max_distance))


def _probes(entries: DataFrame, max_distance: int) -> DataFrame:
    """(fp, z): the keys that each fingerprint looks up, the ball of half the distance around its own."""
    if max_distance < 2:
        return entries.select("fp", F.col("key").alias("z"))
    flip = F.explode(F.sequence(F.lit(0), F.lit(32))).alias("i")  # 32: none
    return entries.select("fp", "key", flip).select("fp", F.expr("key ^ CASE WHEN i < 32 THEN shiftleft(1L, i) ELSE 0L END").alias("z"))


def candidates(entries: DataFrame, max_distance: int) -> DataFrame:
    """(u, v), u > v: fingerprints of ``entries`` (fp, key) that meet in a segment's table, whatever their complete distance."""
    table = entries.select(F.col("fp").alias("v"), "key").hint("shuffle_hash")
    met = _probes(entries, max_distance).join(table, F.col("z") == F.col("key"))
    return met.where("fp > v").select(F.col("fp").alias("u"), "v")


def _stars(fps: DataFrame, max_distance: int) -> DataFrame:
    """Links by the whole fingerprint less one bit: a bit set of its members for each entry, and a star from the first."""
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flip = F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i")  # 64: none
    bit = F.expr("CASE WHEN i < 64 THEN shiftleft(1L, i) ELSE 0L END")
    entries = (fps.select("fp").repartition(n).select("fp", flip).select(F.col("fp").bitwiseXOR(bit).alias("z"), bit.alias("b"))
               .groupBy("z").agg(F.bit_or("b").alias("flips"), F.max(F.col("b") == 0).alias("itself"))
               .where(F.bit_count("flips") + F.col("itself").cast("int") >= 2))
    members = F.expr("concat(CASE WHEN itself THEN array(z) ELSE array() END, "
                     "transform(filter(sequence(0, 63), i -> (shiftright(flips, i) & 1L) = 1L), i -> z ^ shiftleft(1L, i)))")
    return (entries.select(members.alias("m"))
            .select(F.col("m")[0].alias("u"), F.explode(F.expr("slice(m, 2, 64)")).alias("v"))
            .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_distance))


def _components_by_fp(rows: DataFrame, max_distance: int) -> DataFrame:
    """fp, root (a fingerprint of its component), component_id (smallest id there) for each distinct fingerprint of ``rows`` (doc_id, fp)."""
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    found = components(links(fps.select("fp"), max_distance))
    inside = materialize(fps.join(found.withColumnRenamed("node", "fp"), "fp"), "linked")
    root = materialize(inside.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    linked = inside.join(root, "root").select("fp", "root", "component_id")
    # a linked component without any id has none; a fingerprint alone has its own
    alone = F.col("root").isNull()
    return materialize(fps.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.when(alone, F.col("least")).otherwise(F.col("component_id")).alias("component_id")), "classes")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_distance: int = 2) -> DataFrame:
    """doc_id, fp, component_id, a row for each row of ``df``.

    component_id is the smallest id reachable over links, itself included.
    Null and empty texts have fingerprint zero and are linked like any other;
    rows with a null id take part and are never the smallest (null if a
    component has no other). Repeated rows are returned each.
    """
    rows = _rows(df, id_col, text_col, shingle)
    return rows.join(_components_by_fp(rows, max_distance).drop("root"), "fp").select("doc_id", "fp", "component_id")


def _rows(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    fp = with_fingerprint(df, text_col, shingle, "_simhash", keep=[id_col])
    return materialize(fp.select(F.col(f"`{id_col}`").alias("doc_id"), F.col("_simhash.value").alias("fp")), "simhash")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """The rows of ``df`` with the smallest id of each component, one row a component, all columns.

    Where an id is repeated, or null, rows are told apart by their own
    fingerprint and one of each component stays.
    """
    rows = _rows(df, id_col, text_col, shingle)
    classes = _components_by_fp(rows, max_distance)
    best = rows.join(classes, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    ids = materialize(best.groupBy("doc_id").agg(F.count("*").alias("n")), "kept-ids")
    mine = F.col(f"`{id_col}`")
    single = ids.where("n = 1").select(F.col("doc_id").alias("_kept"))
    # an id that is unique among the kept rows may still be repeated outside its component
    repeated = materialize(rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_again")), "repeated-ids")
    # the kept ids grow with the rows: they are met by one exchange of the rows, at every size
    kept = df.join(single.hint("shuffle_hash"), mine.eqNullSafe(F.col("_kept")), "left_semi")
    if repeated.isEmpty():
        return kept
    plain = kept.join(repeated, mine.eqNullSafe(F.col("_again")), "left_anti")
    again = df.join(repeated, mine.eqNullSafe(F.col("_again")), "left_semi")
    tagged = with_fingerprint(again, text_col, shingle, "_simhash").withColumn("_fp", F.col("_simhash.value"))
    one = Window.partitionBy("_root").orderBy("_fp", F.xxhash64(F.col(f"`{text_col}`")))
    chosen = (tagged.join(classes.select(F.col("fp").alias("_fp"), F.col("component_id").alias("_class"), F.col("root").alias("_root")), "_fp")
              .where(mine.eqNullSafe(F.col("_class"))).withColumn("_nth", F.row_number().over(one)).where("_nth = 1"))
    return plain.select(*[f"`{c}`" for c in df.columns]).union(chosen.select(*[f"`{c}`" for c in df.columns]))
