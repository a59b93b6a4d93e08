import random
import re

import pytest
import xxhash

from tessera.llm import simhash as S
from tessera.llm.graph import components


def brute_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, r):
    """fps: list of (id, fp); smallest id of each row's component."""
    up = {f: f for _, f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    fs = list(up)
    for i, a in enumerate(fs):
        for b in fs[:i]:
            if bin(a ^ b).count("1") <= r:
                up[root(a)] = root(b)
    least = {}
    for i, f in fps:
        k = root(f)
        least[k] = min((x for x in (least.get(k), i) if x is not None), default=None)
    return {(i, f): least[root(f)] for i, f in fps}


def test_fingerprints_and_components(docs):
    want = [(r.doc_id, brute_fp(r.text)) for r in docs.collect() if len(r.text or "") < 20_000]
    got = {(r.doc_id, r.fp % (1 << 64)): r.component_id for r in S.near_duplicates(docs.where("text IS NULL OR length(text) < 20000")).collect()}
    assert got == brute_components(want, 2)


def test_long_text_is_summed_in_parts(monkeypatch):
    text = " ".join(f"w{i * 7919 % 1000}" for i in range(5000)).encode()
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "PART", 64)
    assert S.fingerprint(text) == whole == brute_fp(text.decode())


@pytest.mark.parametrize("crowd", [0, 3, 64])
@pytest.mark.parametrize("r", [0, 1, 2])
def test_links_join_what_brute_force_joins(spark, r, crowd, monkeypatch):
    monkeypatch.setattr(S, "CROWD", crowd)  # 0: all by the second key; 3: some; 64: hardly any
    rnd = random.Random(r)
    fps = set()
    for _ in range(40):  # dense balls, chains and single ones, with sign bits
        f = rnd.getrandbits(64)
        for _ in range(rnd.randrange(1, 25)):
            fps.add(f)
            for _ in range(rnd.randrange(1, 4)):
                f ^= 1 << rnd.randrange(64)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), r)
    assert all(bin((e.u ^ e.v) % (1 << 64)).count("1") <= r for e in edges.collect())
    got = {x.node % (1 << 64): x.root % (1 << 64) for x in components(edges).collect()}
    want = brute_components([(f, f) for f in sorted(fps)], r)
    groups = lambda m: sorted(sorted(k for k in m if m[k] == v) for v in set(m.values()))
    assert groups({f: got.get(f, f) for f in fps}) == groups({f: v for (f, _), v in want.items()})


def test_complete_distance_rejects_candidates(spark):
    """Fingerprints that share a segment, or nearly, and differ elsewhere meet in a table and are no link."""
    low, rnd = 0xDEADBEEF, random.Random(3)
    fps = [low | rnd.getrandbits(32) << 32 for _ in range(40)] + [(low ^ 1) | rnd.getrandbits(32) << 32 for _ in range(10)]
    fps += [fps[0] ^ 1 << 40, fps[0] ^ 1 << 41 ^ 1 << 3]
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    entries = df.selectExpr("fp", "explode(array(fp & 4294967295L, shiftrightunsigned(fp, 32) | 4294967296L)) AS key")
    met = {(r.u % (1 << 64), r.v % (1 << 64)) for r in S.candidates(entries, 2).collect()}
    near = {frozenset((a, b)) for i, a in enumerate(fps) for b in fps[:i] if bin(a ^ b).count("1") <= 2}
    got = {frozenset((r.u % (1 << 64), r.v % (1 << 64))) for r in S.links(df).collect()}
    assert got == near and near < {frozenset(p) for p in met} and len(met) > 700


def test_bad_distance(spark):
    with pytest.raises(ValueError):
        S.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(-40, 60)] + [(100 + i, 100) for i in range(1, 300)] + [(7, 7), (1, 0)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: -40 for i in range(-40, 61)}, **{100 + i: 100 for i in range(300)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_one_of_each_group(docs, none):
    small = docs.where("text IS NULL OR length(text) < 20000")
    kept = S.keep_one(small)
    assert kept.columns == docs.columns
    comp = brute_components([(r.doc_id, brute_fp(r.text)) for r in small.collect()], 2)
    ids = [(r.doc_id, brute_fp(r.text)) for r in kept.collect()]
    assert len(ids) == len({v if v is not None else k for k, v in comp.items()}) and all(comp[i] == i[0] for i in ids)
    assert S.keep_one(none).count() == 0 and S.near_duplicates(none).count() == 0
    assert kept.where("text LIKE 'another text%'").count() == 1  # a null id in a group of its own stays


def test_keep_one_with_unique_ids(spark):
    df = spark.createDataFrame([(i, f"the text of group {i % 5} " * 4) for i in range(50)], "doc_id long, text string")
    assert sorted(r.doc_id for r in S.keep_one(df).collect()) == [0, 1, 2, 3, 4]
