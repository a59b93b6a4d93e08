import re

import pytest

from tessera.llm import license_index as L

NOTICE = {t.label: t.text for t in reversed(L.TEMPLATES)}


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = sorted((i, lab) for p, lab in L.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    return len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))


CASES = ["", None, "MIT License", "the MIT license, mit license; MIT-License. mit licenses", "Mit\x00License CC BY-NC CC_BY cc bY", "GNU\nGeneral\tPublic License v3 apache license",
         "é license mit é", "cc by cc by cc by", "mit license" * 3, "x " * 100_000 + "apache license", "{mit} [license]"]


def test_base(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    for r in L.scan_licenses(df).collect():
        x = r.license
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) == brute(CASES[r.doc_id])
        assert set(filter(None, x.base_labels.split(","))) <= set(filter(None, x.labels.split(","))) and 0 <= x.score <= 1


def test_templates_are_found_whole_shifted_and_changed(spark):
    filler = "a house by the river with windows of stone and a garden to walk in for the day "
    rows = [(i, filler * (i % 5 + 1)) for i in range(200)]
    rows += [(1000 + k, filler + "/* " + t.text.upper() + " */ " + filler) for k, t in enumerate(L.TEMPLATES)]
    bsd = NOTICE["bsd"].split()
    rows += [(2000, " ".join(bsd[:20] + ["oddly"] + bsd[20:])), (2001, " ".join(sorted(bsd))), (2002, " ".join(bsd[:8]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.license for r in L.scan_licenses(df).collect()}
    for k, t in enumerate(L.TEMPLATES):
        assert t.label in got[1000 + k].labels.split(","), t.text
    assert all(got[i].labels == "" and got[i].score < 0.5 for i in range(200))
    assert got[2000].labels == "bsd" and got[2001].labels == "" and got[2002].labels == ""


def test_a_licence_in_every_file_is_still_found(spark):
    df = spark.createDataFrame([(i, f"text {i} Released under the MIT License. Nothing else {i}") for i in range(50)], "doc_id long, text string")
    assert {(r.license.labels, r.license.n_base) for r in L.scan_licenses(df).collect()} == {("mit", 1)}


def test_frames(docs, none):
    got = L.scan_licenses(docs)
    assert got.count() == docs.count() and set(docs.columns) < set(got.columns) and L.scan_licenses(none).count() == 0


@pytest.mark.parametrize("t", L.TEMPLATES)
def test_templates_hold_their_phrases(t):
    assert all(L._has(L.words_of(t.text.encode()), L.words_of(p.encode())) for p in t.phrases)


def test_a_file_with_all_licences_has_all_labels(spark):
    filler = "a house by the river with windows of stone and a garden to walk in for the day "
    every = " ".join(f"{filler} {t.text}" for t in L.TEMPLATES)
    rare = " ".join(sorted({w.decode() for t in L.TEMPLATES for w in L.words_of(t.text.encode())}))
    rows = [(i, filler * (i % 5 + 1)) for i in range(300)] + [(1000, every), (1001, f"{rare} {filler} {NOTICE['isc']}"), (1002, rare)]
    got = {r.doc_id: r.license for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1000].labels == ",".join(sorted(NOTICE)) and got[1000].score == 1
    assert "isc" in got[1001].labels.split(",") and "isc" not in got[1002].labels.split(",")
