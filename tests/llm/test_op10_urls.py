import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import url_vocab as U
from tessera.llm.queries import URL_RULES


def brute(url):
    url = url or ""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    low = url.lower()
    found = lambda terms: sorted(t for t in terms if re.search(f"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", low))
    strict, soft = found(U.STRICT), found(U.SOFT)
    verdict = rule.verdict if rule else "block" if strict or len(soft) > 1 else "allow"
    return host, path, rule and rule.name, verdict, strict, soft


CASES = [None, "", "no scheme", "://", "http://", "http://ORG", "https://a.ORG/x?y=/z#q", "http://org/", "http://xorg/", "http://example.org/es/1", "http://example.org/en/1",
         "http://www.example.org/en/2", "http://a.com/fr/", "http://a.com/de/x", "http://a.com/DE/x", "http://Sex.example.net/", "http://essex.example.net/sexton",
         "http://free-bets.example.net/", "http://x.net/free/win", "http://x.net/free?free", "http://x.net/free_win", "ftp://a://b/c", "http://é.net/İstanbul/poker",
         "http://a.net/" + "x/" * 50_000 + "casino", "http://u:p@h.org:80/en", "http://a.net/xxxxx", "http://a\nb.org/c\nd"]


@pytest.fixture(scope="module")
def judged(spark):
    df = spark.createDataFrame([(i, u, "kept") for i, u in enumerate(CASES)] * 2, "page_id long, url string, host string")
    return U.judge_urls(df, URL_RULES).collect()


def test_judgements(judged):
    assert len(judged) == 2 * len(CASES)
    for r in judged:
        j = r.judged
        assert (j.host, j.path, j.rule, j.verdict, j.strict, j.soft) == brute(CASES[r.page_id]), CASES[r.page_id]
        assert r.host == "kept"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["sex", "free", "win", "bets", "x", "-", "/", ".", "1", "İ", "SEX", "winner"]), max_size=8))
def test_terms(parts):
    url = "".join(parts)
    assert U.term_hits(url) == tuple(brute(url)[4:])


def test_other_settings(spark):
    df = spark.createDataFrame([(1, "http://a.net/free/win"), (2, "http://a.net/casino")], "page_id long, url string")
    got = {r.page_id: r.judged.verdict for r in U.judge_urls(df, [], strict=(), soft=(), min_soft=1).collect()}
    assert got == {1: "allow", 2: "allow"}
    assert U.judge_urls(df.where("1 = 0"), URL_RULES).count() == 0
