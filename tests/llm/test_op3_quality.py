import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import quality as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {p for i in range(len(words) - 2) if n[tuple(words[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines, seen, dup = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": dup, "n_repeat_words": len(covered), "n_lines": len(lines),
            "n_upper_words": sum(bool(re.search("[A-Z]", w)) and not re.search("[a-z]", w) for w in words)}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab A\n\t|#é\x1c\x85", max_size=80))
def test_measures(text):
    assert Q.measure(text.encode()) == brute(text)


def test_ledger(docs):
    for r in Q.ledger(docs).collect():
        m = brute(r.text)
        assert {k: r.ledger[k] for k in m} == m
        assert r.ledger.failed == sum(1 << x.bit for x in Q.RULES if x.fails(m))


def test_null_and_empty_texts_fail(docs, none):
    got = Q.ledger(docs).where("text IS NULL OR trim(text) = ''")
    assert got.count() > 1 and got.where(~Q.fails(F.col("ledger.failed"), Q.BASE)).count() == 0
    assert Q.ledger(none).count() == 0


@pytest.mark.parametrize("policy", [Q.BASE, Q.PRODUCTION, Q.STRICT, Q.Policy("lenient", Q.STRICT.rules, allowed=1)])
def test_policies_and_ablations_from_the_bits(docs, policy):
    led = Q.ledger(docs)
    masks = [r.failed for r in led.select("ledger.failed").collect()]
    bits = {r.name: 1 << r.bit for r in Q.RULES}
    out = lambda m, names: sum(bool(m & bits[n]) for n in names) > policy.allowed
    assert led.where(Q.fails(F.col("ledger.failed"), policy)).count() == sum(out(m, policy.rules) for m in masks)
    got = {r.rule: (r.n_failed, r.n_only_by_it) for r in Q.ablations(led, policy).collect()}
    for rule in policy.rules:
        rest = [n for n in policy.rules if n != rule]
        assert got[rule] == (sum(bool(m & bits[rule]) for m in masks), sum(out(m, policy.rules) and not out(m, rest) for m in masks))
