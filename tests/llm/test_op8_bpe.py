import base64
import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import duck_bpe as D

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def both(texts):
    c = D.codec(PATH, PATTERN)
    ids, n = c.encode(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])], c.decode(ids, n)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab 's\n\t.\x1c\x85　é1日😀", max_size=30), min_size=1, max_size=4))
def test_ids_are_tiktokens(reference, texts):
    ids, back = both(texts)
    assert ids == [reference(t) for t in texts] and back == [t.encode() for t in texts]


@pytest.mark.parametrize("text", ["", " ", "   x", "a   b", "a \n b", "\n\nx \n", "a" * 3000, "it's I'LL <|endoftext|>", "\x00\x01", " trailing  ", "x\r\ny"])
def test_edges(reference, text):
    assert both([text, None, text])[0] == [reference(text), [], reference(text)]


def test_long_text(reference):
    text = " ".join(f"word{i * 37 % 1009} other" for i in range(60_000)) + "."
    ids, back = both([text])
    assert ids == [reference(text)] and back == [text.encode()]


def words_without_spaces(kind, n):
    rnd = random.Random(n)
    if kind == "base64":
        return base64.b64encode(rnd.randbytes(n * 3 // 4)).decode()
    if kind == "cjk":
        return "".join(chr(rnd.randrange(0x4E00, 0x9FFF)) for _ in range(n))
    if kind == "letters":
        return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    return "".join(rnd.choice(["the", "quick", "ing", "lazy", "nation", "aa", "a"]) for _ in range(n // 4))


@pytest.mark.parametrize("kind", ["base64", "cjk", "letters", "words"])
@pytest.mark.parametrize("n", [70, 5_000, 200_000])
def test_long_words(reference, kind, n):
    text = words_without_spaces(kind, n)
    start = time.monotonic()
    ids, back = both([text, "short ones " + text[:40], None])
    assert time.monotonic() - start < 20
    assert ids == [reference(text), reference("short ones " + text[:40]), []] and back[0] == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abthein日", min_size=1, max_size=150), min_size=1, max_size=5))
def test_all_places_of_a_pair_at_once(reference, words):
    c = D.codec(PATH, PATTERN)
    raw = [w.encode() for w in words]
    flat, n = c.contract(raw)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(D, "LONG", 0)
        again = c.contract(raw)
    assert flat.tolist() == again[0].tolist() and n.tolist() == again[1].tolist()
    assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [reference(w) for w in words]


def test_ranks_out_of_order_take_the_leftmost_pair(tmp_path):
    """A token of a lower rank than its part: places are contracted one at a time."""
    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"ab"]
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    c = D.DuckBpe(str(path), PATTERN)
    assert not c.ordered() and D.codec(PATH, PATTERN).ordered()
    assert c.encode(["ab" * 50 + "abc"])[0].tolist() == [257] * 50 + [256]


def test_memory_may_forget(reference, monkeypatch):
    monkeypatch.setattr(D, "REMEMBERED", 5)
    monkeypatch.setattr(D, "BYTES_AT_ONCE", 40)
    c = D.DuckBpe(PATH, PATTERN)
    for i in range(40):
        text = f"unheard{i}wording of{i % 4} and\nline{i % 3}"
        assert c.encode([text])[0].tolist() == reference(text)


def test_frames(docs, none, reference):
    small = docs.where("text IS NULL OR length(text) < 20000")
    enc = D.encode(small, PATH, PATTERN, out="bpe")
    rows = enc.collect()
    assert all(r.bpe.ids == reference(r.text or "") for r in rows)
    dec = D.decode(enc.withColumn("ids", F.col("bpe.ids")), PATH, PATTERN)
    assert all(bytes(r.decoded.bytes) == (r.text or "").encode() for r in dec.collect())
    for r in D.round_trip(small, PATH, PATTERN).collect():
        ids = np.array(reference(r.text or ""), "<u4")
        assert (r.bpe.n_tokens, r.bpe.ids_sha256, r.bpe.decoded_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    assert D.round_trip(none, PATH, PATTERN).count() == 0


def test_unknown_id(spark):
    df = spark.createDataFrame([([1, 99_999_999],)], "ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        D.decode(df, PATH, PATTERN).collect()
    assert bytes(D.decode(spark.createDataFrame([(None,)], "ids array<int>"), PATH, PATTERN).first().decoded.bytes) == b""


def test_a_query_holds_few_words_and_texts(monkeypatch):
    """Six workers share an executor of 3,000 MB: a megabyte of new words, or four of texts, in one query took 350 MB each."""
    bpe, calls = D.DuckBpe(PATH, PATTERN), []
    monkeypatch.setattr(bpe, "contract", lambda words: calls.append(sum(map(len, words))) or (np.zeros(len(words), np.int32), np.ones(len(words), int)))
    bpe.learn_pieces([f"zq{i:x}xv" * 3 for i in range(40_000)])
    assert sum(calls) > 700_000 and max(calls) <= 300_000
    assert D.TEXT_AT_ONCE <= 1 << 20
