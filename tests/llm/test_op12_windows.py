import hashlib
import random

import numpy as np
import pytest

from tessera.llm import window_dedup as wd
from tests.llm.conftest import sentence


def brute(rows, k=13):
    """(id, n_words, n_removed, kept) of (id, text) rows."""
    least, cut = {}, [(d, t.encode().split() if t else []) for d, t in rows]
    for d, words in cut:
        for i in range(len(words) - k + 1):
            w = tuple(words[i:i + k])
            if d is not None:
                least[w] = min(d, least.get(w, d))
    out = []
    for d, words in cut:
        gone = set()
        for i in range(len(words) - k + 1):
            if d is not None and least[tuple(words[i:i + k])] < d:
                gone.update(range(i, i + k))
        out.append((d, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return out


def same(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, 1, "m") for d, t in rows], "doc_id long, text string, doc int, mark string").repartition(6)
    got = wd.remove_repeats(df, **kw)
    assert got.columns == ["doc_id", "text", "doc", "mark", "repeats"]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([(r.doc_id, *r.repeats) for r in got.collect()], key=key) == sorted(brute(rows, kw.get("k", 13)), key=key)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    common = sentence(rnd, 50)
    phrase = "please accept all of our cookies to go on"
    out = []
    for i in range(240):
        text = sentence(rnd, rnd.randrange(90))
        if i % 3 == 0:
            text += " " + common + "\t" + sentence(rnd, rnd.randrange(30))
        if i % 4 == 0:
            text += " \n" + phrase + " " + sentence(rnd, 20)
        out.append((i, text))
    out += [(i + 300, out[i % 7][1]) for i in range(80)]  # copies
    out += [(None, out[0][1]), (None, common), (7, out[8][1]), (7, "other " + out[8][1]), out[12], out[12], (500, None), (501, ""), (502, " \x0b "), (503, "w " * 4000),
            (504, "w " * 20), (505, "x" * 300 + " " + common + " " + "y" * 300), (506, "x" * 300 + " " + common), (-5, out[3][1]), (507, "é ü　z " * 9 + common),
            (508, sentence(rnd, 30_000))]
    return out


def test_against_brute_force(spark, rows):
    same(spark, rows)


def test_crowded_buckets_go_on(spark, rows):
    """With small buckets all of the frequent minimisers' strings take the second round."""
    same(spark, rows, target=2000, limit=4000)
    same(spark, rows, k=5, m=5, target=3000, limit=3000)
    same(spark, rows, k=6, m=1, target=100_000, limit=2000)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert wd.remove_repeats(df).count() == 0
    same(spark, [(1, None), (None, None), (2, "a b")])


def test_equal_hashes_are_told_apart(monkeypatch):
    """A hash that confuses windows costs another round, not a wrong result."""
    real, seeds = wd.run_hashes, []

    def weak(values, n, seed=0):
        seeds.append(seed)
        return real(values, n, seed) % np.uint64(3 if seed < 2 else 2**63)
    monkeypatch.setattr(wd, "run_hashes", weak)
    codes = np.random.default_rng(1).integers(0, 4, 200).astype(np.uint64)
    start, doc = np.arange(198), np.arange(198) % 11
    small = wd.Bucket.smallest(codes, start, doc, 3)
    want = {}
    for i in start:
        want[tuple(codes[i:i + 3])] = min(doc[i], want.get(tuple(codes[i:i + 3]), 99))
    assert small.tolist() == [want[tuple(codes[i:i + 3])] for i in start] and seeds == [0, 1, 2]


def test_equal_strings_travel_once(spark):
    """Copies fold where they are read: what is exchanged does not grow with them."""
    text = sentence(random.Random(2), 400)
    import pyarrow as pa
    sizes = []
    for n in (2, 500):
        rows = list(wd.super_kmers(np.arange(n), np.zeros(n, np.int64), pa.array([text] * n), 13, 4, 8))
        sizes.append(sum(r[2] for r in rows if r[1] == wd.STRINGS))
    assert sizes[0] == sizes[1]


def test_query(spark):
    from tessera.llm import queries
    from tests.conftest import SF
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {d: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute([(r.doc_id, r.text) for r in docs])}
    got = {r[0]: tuple(r[1:]) for r in queries.op12_superkmer_dedup(spark, SF).collect()}
    assert got == want and sum(g for _, g, _ in got.values()) > 0
