import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import importance_sample as im
from tests.conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]


def brute(docs, bench, least=20, percent=25, seed=7):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = Counter(), Counter()
    for texts, count in ((x for _, x in docs), s), (bench, t):
        for x in texts:
            count.update(map(bucket, features(x)[1]))
    big_s, big_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
    out = []
    for d, x in docs:
        words, fs = features(x)
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 4294967296))), len(words) >= least])
    able = sorted([r for r in out if r[4]], key=lambda r: (-r[3], -math.inf if r[0] is None else r[0]))
    ranks = {id(r): i + 1 for i, r in enumerate(able[:len(able) * percent // 100])}
    return [(*r[:4], ranks.get(id(r))) for r in out]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_op(spark, docs):
    bench = ["river stone river", None, "", "lantern MARKET 12 ü copper window garden"]
    got = im.resample(docs, spark.createDataFrame([(x, 1) for x in bench], "text string, rank int"))
    assert got.columns == [*docs.columns, "sample"]
    want = brute([(r.doc_id, r.text) for r in docs.collect()], bench)
    rows = [(r.doc_id, *r.sample) for r in got.collect()]
    assert sorted((r[:4] for r in rows), key=key) == sorted((r[:4] for r in want), key=key)
    # repeated rows share their ranks in any order
    ranked = lambda rs: sorted((r[4], r[3], r[0] is None) for r in rs if r[4])
    assert ranked(rows) == ranked(want) and len(ranked(rows)) >= 2


def test_empty(spark, none, docs):
    bench = spark.createDataFrame([("a b",)], "text string")
    assert im.resample(none, bench).count() == 0
    assert im.resample(docs, bench.where("1 = 0")).count() == docs.count()


def test_query(spark):
    from tessera.llm import queries
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op13_radix_resample(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute([(r.doc_id, r.text) for r in docs], bench), key=key)


def test_radix_rank(spark):
    """Small digits and parts, negative and wide values, ties, a hot value."""
    rnd = random.Random(6)
    rows = [(rnd.choice([-7, 3, 3, 3, 3, rnd.randrange(-10**6, 10**6)]), rnd.randrange(-2**63, 2**63), i) for i in range(700)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "a long, b long, at int, digit string").repartition(5)
    got = {r["at"]: r["rank"] for r in im.radix_rank(df, [F.col("a"), F.col("b")], digit=13, part=60).collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda x: x[1])] == [r[2] for r in sorted(rows)] and sorted(got.values()) == list(range(1, 701))
    tied = im.radix_rank(df.select(F.lit(4).alias("a"), "at"), [F.col("a")], digit=2, part=100)
    assert sorted(r["rank"] for r in tied.collect()) == list(range(1, 701))


def test_joined_crc():
    rnd = random.Random(2)
    left = [rnd.randbytes(rnd.randrange(20)) for _ in range(500)]
    right = [rnd.randbytes(rnd.randrange(40)) for _ in range(500)]
    got = im.joined_crc(np.array([zlib.crc32(x) for x in left], np.uint32), np.array([zlib.crc32(x) for x in right], np.uint32),
                        np.array([len(x) for x in right]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(left, right)]


def test_very_long_words():
    f = im.Features(1000)
    text = b"a" * 5000 + b" b " + b"c" * 9000
    got = f.of([text, None, b""])
    words = text.split()
    want = [zlib.crc32(x) % 1000 for x in (*words, b" ".join(words[:2]), b" ".join(words[1:]))]
    assert got[0].tolist() == want and got[2].tolist() == [3, 0, 0]
