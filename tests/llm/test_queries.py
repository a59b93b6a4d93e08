"""Every query over its whole table of the smallest data, against brute force."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import decontaminate, queries, quality, secret_scan
from tests.conftest import SF
from tests.llm.test_op3_quality import brute as measures
from tests.llm.test_op4_simhash import brute_components, brute_fp
from tests.llm.test_op5_secrets import brute as base_spans
from tests.llm.test_op6_license import brute as base_license


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas()


@pytest.fixture(scope="module")
def got(spark):
    seen = {}

    def of(name):
        if name not in seen:
            seen[name] = queries.QUERIES[name](spark, SF).toPandas()
        return seen[name]
    return of


def of_doc(df, key="doc_id"):
    return df.set_index(key).sort_index()


def encoder():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_op1(documents, got):
    r = got("op1_histogram_shards")
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in zip(documents.doc_id, documents.text))
    assert Counter(zip(r.doc_id, r["size"], r.text_crc32)) == want
    assert set(r.law) == {"bytes"} and r.grown_shard.isna().all() and r.shard.between(0, 39).all()
    assert all(sorted(g) == list(range(len(g))) for _, g in r.groupby("shard").slot)


def test_op2(spark, got):
    """The test pages hold their text in one article of headings and paragraphs."""
    import html
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas()
    r = of_doc(got("op2_mincut_text"), "page_id")
    for p in pages.itertuples():
        blocks = re.split(r"</?(?:p|h1)>", re.search(r"(?s)<article>(.*?)</article>", p.html)[1])
        want = "\n".join(x for x in (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks) if x)
        assert (r.text[p.page_id], r.n_chars[p.page_id], r.url[p.page_id]) == (want, len(want), p.url)


def test_op3(documents, got):
    r = of_doc(got("op3_quality_ledger"))
    for d, t in zip(documents.doc_id, documents.text):
        m = measures(t)
        assert {k: r[k][d] for k in m if k in r} == {k: v for k, v in m.items() if k in r}
        base = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        assert r.base_failed[d] == base and not (base and r.kept[d])


def test_op4(documents, got):
    fps = [(d, brute_fp(t)) for d, t in zip(documents.doc_id, documents.text)]
    comp = brute_components(fps, 2)
    r = of_doc(got("op4_simhash_index"))
    assert all((r.fingerprint[d], r.component_id[d]) == (f"{f:016x}", comp[d, f]) for d, f in fps) and len(r) == len(fps)


def test_op5(documents, got):
    r = of_doc(got("op5_secret_ownership"))
    for d, t in zip(documents.doc_id, documents.text):
        base = base_spans(t)
        n = Counter(x.split(":")[0] for x in base.split(",") if x)
        assert (r.n_assign[d], r.n_access[d], r.n_hex[d]) == (n["assign"], n["access"], n["hex"])
        assert r.base_sha256[d] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans[d].split(","))


def test_op6(documents, got):
    r = of_doc(got("op6_license_index"))
    for d, t in zip(documents.doc_id, documents.text):
        n, base, first, last, labels = base_license(t)
        assert (r.n_words[d], r.n_base[d], r.base_labels[d]) == (n, base, labels)
        assert (None if np.isnan(r.first_word[d]) else r.first_word[d], None if np.isnan(r.last_word[d]) else r.last_word[d]) == (first, last)
        assert set(filter(None, labels.split(","))) <= set(filter(None, r.labels[d].split(","))) and 0 <= r.score[d] <= 1


def test_op7(documents, got):
    docs = documents.sort_values("doc_id")
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [e.ids + [2] for e in t.encode_batch(list(docs.text.fillna("")), add_special_tokens=False)]
    r = got("op7_simple8b_ids").sort_values("doc_id")
    assert r.doc_id.tolist() == docs.doc_id.tolist() and r.n_tokens.tolist() == list(map(len, ids))
    assert r.start.tolist() == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert r.ids_crc32.tolist() == [zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids]


def test_op8(documents, got):
    enc, r = encoder(), of_doc(got("op8_duckdb_bpe"))
    for d, t in zip(documents.doc_id, documents.text):
        ids = np.array(enc(t or ""), "<u4")
        assert (r.n_tokens[d], r.ids_sha256[d], r.decoded_sha256[d]) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


def brute_leaks(spark, docs):
    """(doc_id, item_id) by sets of whole windows, without hashes, bit map or joins."""
    c, out = decontaminate.Canon(), set()
    docs, bench = list(docs), spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    for form in decontaminate.FORMS:
        canonical = lambda t: c.forms([(t or "").encode()])[form][1].tolist()  # noqa: B023, E731
        items = {r.item_id: canonical(r.text) for r in bench}
        where = defaultdict(set)
        for i, toks in items.items():
            for k in range(len(toks) - 7):
                where[tuple(toks[k:k + 8])].add((i, k))
        for d, t in docs:
            mine, hit = canonical(t), defaultdict(set)
            for k in range(len(mine) - 7):
                for i, at in where.get(tuple(mine[k:k + 8]), ()):
                    hit[i].update(range(at, at + 8))
            out |= {(d, i) for i, seen in hit.items() if len(seen) >= min(13, len(items[i]))}
    return out


def test_op9(spark, documents, got):
    r = got("op9_template_leaks")
    assert set(zip(r.doc_id, r.item_id)) == brute_leaks(spark, zip(documents.doc_id, documents.text)) and len(r)


def test_pipeline(spark, documents):
    docs = [(d.doc_id, d.text, d.source, d.lang) for d in documents.itertuples()]

    def clean(t):
        m = measures(t)
        return not any(x.fails(m) for x in quality.RULES if x.name in quality.PRODUCTION.rules)

    docs = [d for d in docs if clean(d[1])]
    comp = brute_components([(d[0], brute_fp(d[1])) for d in docs], 2)
    docs = [d for d in docs if comp[d[0], brute_fp(d[1])] == d[0]]
    leaky = {d for d, _ in brute_leaks(spark, [d[:2] for d in docs])}
    docs = [d for d in docs if d[0] not in leaky]
    owners = defaultdict(set)
    found = {d[0]: secret_scan.scan_text(d[1].encode())[2] for d in docs}
    for d in docs:
        for v in found[d[0]]:
            owners[v["hash"]].add(d[2])
    enc, want = encoder(), {}
    for d, t, _, _ in docs:
        live = sorted((v["start"], v["end"]) for v in found[d] if v["strong"] and len(owners[v["hash"]]) <= 2)
        out, end = "", 0
        for a, b in live:
            out, end = (out + t[end:a] + "[SECRET]" if a >= end else out), max(end, b)
        text = out + t[end:]
        ids = np.array(enc(text), "<u4")
        want[d] = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and want


def test_stages_keep_the_columns_and_take_odd_rows(spark, docs, none):
    """Null and repeated ids, null and empty texts, clashing extra columns, an empty table."""
    for rows in (docs.where("text IS NULL OR length(text) < 20000"), none):
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            rows = corpus_pipeline.materialize(stage(spark, rows, SF), name)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert rows.columns == docs.columns, name
        assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_names_and_oracles():
    assert sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0])) == list(queries.QUERIES)
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES) and corpus_pipeline.ORACLE_SQL is None
