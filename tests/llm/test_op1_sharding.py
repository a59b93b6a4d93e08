import os
import zlib
from collections import Counter, defaultdict

import pytest

from tessera.llm.sharding import GROUP, _probes, shard_by_bytes, shard_rows


def rows_of(df, **kw):
    return [r.asDict() for r in shard_by_bytes(df, **kw).collect()]


@pytest.mark.parametrize("n", [1, 3, 40])
def test_every_row_once_with_gapless_slots(docs, n):
    got = rows_of(docs, n_shards=n)
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r["shard"] < n
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_bytes_are_near_equal_also_with_a_hot_text(spark):
    df = spark.createDataFrame([(i, "hot " * 50 if i % 3 == 0 else f"text number {i} " * 14) for i in range(6000)], "doc_id long, text string")
    got = rows_of(df, n_shards=8, rows_a_range=200)
    size = Counter()
    for r in got:
        size[r["shard"]] += r["size"]
    share, most = sum(size.values()) / 8, max(r["size"] for r in got)
    assert len(size) == 8 and all(abs(v - share) <= 0.011 * share + 2 * most for v in size.values())
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_copies_share_a_shard_where_the_tolerance_allows(spark):
    df = spark.createDataFrame([(i, f"text number {i // 2} " * 5) for i in range(4000)], "doc_id long, text string")
    shards = defaultdict(set)
    for r in rows_of(df, n_shards=4, tolerance=0.05):
        shards[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


def test_empty_table(none):
    got = shard_by_bytes(none)
    assert got.count() == 0 and got.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]


def test_probes_fall_between_texts_while_they_can():
    assert all(p % GROUP == 0 for p in _probes(-(1 << 63), 1 << 63, 255))
    assert _probes(0, GROUP, 3) and all(0 < p < GROUP for p in _probes(0, GROUP, 3))
    assert _probes(5, 6, 3) == []


def test_shards_hold_the_whole_rows(docs, none):
    """Texts and extra columns arrive, in the order of the slots, in a folder for each shard."""
    extra = docs.withColumnRenamed("shard", "_key")
    got = shard_rows(extra, n_shards=3)
    names = [c for c in extra.columns if c != "slot"]
    assert got.columns == [*names, "shard", "slot"]
    assert Counter(got.select(*names).collect()) == Counter(extra.select(*names).collect())
    files = got.inputFiles()
    assert {os.path.basename(os.path.dirname(f)) for f in files} == {f"shard={k}" for k in {r.shard for r in got.collect()}}
    for f in files:
        slots = [r.slot for r in got.sparkSession.read.parquet(f).select("slot").collect()]
        assert slots == sorted(slots)
    assert shard_rows(none).count() == 0 and "text" in shard_rows(none).columns


def test_ranges_are_bounded_by_bytes_too(docs):
    got = shard_rows(docs, n_shards=2, bytes_a_range=1000).select("shard", "slot").collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) <= {0, 1} and all(sorted(v) == list(range(len(v))) for v in slots.values())
