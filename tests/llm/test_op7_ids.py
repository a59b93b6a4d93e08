import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import simple8b as B
from tessera.llm.token_files import WordEncoder, encoder, read_ids, write_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(texts):
    """A tokenizer as it comes from the file, plain calls."""
    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def coded(texts, enc):
    ids, n = enc.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB 's\n\t.,\x1c\x85　é́İΣ<|1٣日", max_size=40))
def test_ids_are_the_librarys(text):
    assert coded([text], encoder(PATH)) == whole([text])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "<", "a", "B", " ", "\n", "É", "\u0301", "日", ".", "'s", "İ"]), max_size=9))
def test_added_tokens_are_the_librarys(parts):
    assert coded(["".join(parts)], encoder(PATH)) == whole(["".join(parts)])


def test_a_hot_id_has_several_parts(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text number {i} " * (i % 5)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    manifest = write_ids(df, PATH, 2, parts=12)
    sizes = [r.n_docs for r in manifest.collect()]
    assert sum(sizes) == 600 and max(sizes) < 130
    got = sorted(read_ids(manifest).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    want = sorted(zlib.crc32(np.array(x + [2], "<u4").tobytes()) for x in whole([t for _, t in rows]))
    assert sorted(r.ids_crc32 for r in got) == want
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()


def test_memory_may_forget(monkeypatch):
    monkeypatch.setattr("tessera.llm.token_files.REMEMBERED", 3)
    enc = WordEncoder(PATH)
    texts = [f"word{i} other, {i % 3}" for i in range(60)] * 2
    assert [coded([t], enc)[0] for t in texts] == whole(texts)


@pytest.mark.parametrize("n", [0, 1, 59, 511, 512, 513, 4000])
@pytest.mark.parametrize("top", [1, 2, 300, 49408, 1 << 33, (1 << 60) + 9, (1 << 64) - 1])
def test_blocks_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64, endpoint=True)
    ids[::9] = 0
    escapes = []
    words, used = B.encode_blocks(ids, escapes)
    sizes = np.full(len(used), B.BLOCK)
    if n:
        sizes[-1] = n - (len(used) - 1) * B.BLOCK
    assert (B.decode_blocks(words, used, sizes, np.array(escapes, np.uint64)) == ids).all() and len(words) == used.sum()
    if top <= 2:
        assert not n or len(words) <= -(-n // 30) + len(used)


def test_file_and_random_blocks(tmp_path):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, rng.integers(0, 4000), dtype=np.uint64) for _ in range(500)] + [np.arange(600_000, dtype=np.uint64)]
    w = B.Writer(f"file://{tmp_path}/f")
    for i, d in enumerate(docs):
        w.add(i if i else None, d)
    w.close()
    r = B.Reader(w.path)
    at = np.cumsum([0, *map(len, docs)])
    assert list(r.documents()) == [(i if i else None, int(at[i]), len(d), zlib.crc32(d.astype("<u4").tobytes())) for i, d in enumerate(docs)]
    every = np.concatenate(docs)
    assert (r.blocks(7, 3) == every[7 * B.BLOCK:10 * B.BLOCK]).all()


def test_cut_file_is_refused(tmp_path):
    w = B.Writer(f"file://{tmp_path}/g")
    w.add(1, np.arange(2000, dtype=np.uint64))
    w.close()
    path = w.path.removeprefix("file://")
    raw = open(path, "rb").read()
    open(path, "wb").write(raw[:-5])
    with pytest.raises(ValueError):
        B.Reader(w.path)


@pytest.mark.parametrize("parts", [1, 7])
def test_documents_to_files_and_back(docs, parts):
    got = sorted((r.asDict() for r in read_ids(write_ids(docs, PATH, 2, parts=parts)).collect()), key=lambda r: r["start"])
    rows = docs.select("doc_id", "text").collect()
    ids = [x + [2] for x in whole([r.text for r in rows])]
    assert [r["doc_id"] is not None for r in got] == sorted(r["doc_id"] is not None for r in got)
    with_id = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert with_id == sorted(with_id)
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    key = lambda d, x: (d is not None, d or 0, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
    assert sorted(key(r.doc_id, x) for r, x in zip(rows, ids)) == sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got)


def test_empty_table(none):
    assert read_ids(write_ids(none, PATH, 2)).count() == 0
