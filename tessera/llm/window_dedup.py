"""Removal of repeated passages: windows of words meet in super-k-mer buckets.

A window is ``k`` consecutive words; its minimiser is the least hash of the
runs of ``m`` words in it. Consecutive windows of a text that share a minimiser
(a super-k-mer) travel as one packed string to the minimiser's bucket, where
the windows are sorted and equal ones meet: the hash that sorts them is checked
word by word, so that the outcome is exact.

Equal strings fold before the exchange: of those that one task reads, the
smallest doc_id travels, and the others' windows are settled there and then. A
bucket of a frequent minimiser (a phrase that very many texts hold in different
surroundings) that outgrows ``LIMIT`` is not worked on: its strings go on to a
second round, in which each window has a bucket of its own and folds again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, release, slices

#: Text bytes that are cut into strings at a time, and bytes of strings in one row.
SLICE, ROW = 8 << 20, 1 << 20
#: Bytes of strings that a bucket has on average, and past which it goes to the second round.
TARGET, LIMIT = 24 << 20, 96 << 20
#: Windows in one string at most; bytes of a word past which its digest stands for it.
RUN, LONG = 256, 64
#: Bytes in the map of repeated ids (see ``marks``), and partitions of an exchange at most.
MAP, PARTITIONS = 1 << 16, 1 << 14
STRINGS, RANGES = 0, 1
_MIX = np.uint64(0x9E3779B97F4A7C15)
PACKED = "bucket int, kind int, size long, data binary"
FOUND = "doc long, mark long, first long, last long, size long, data binary"


def sliding_min(a: np.ndarray, n: int) -> np.ndarray:
    size = 1
    while 2 * size <= n:
        a, size = np.minimum(a[:-size], a[size:]), 2 * size
    return a if size == n else np.minimum(a[:size - n], a[n - size:])


def run_hashes(values: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` values."""
    size = len(values) - n + 1
    out = np.full(size, np.uint64((seed * 2 + 1) * int(_MIX) % 2**64))
    for j in range(n):
        out = (out ^ values[j:j + size]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def word_lists(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of words of each text, and all words; a long word as its digest, after a byte that no word has."""
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    full = pc.greater(pc.binary_length(trimmed), 0)
    lists = pc.ascii_split_whitespace(trimmed.filter(full))
    n = np.zeros(len(texts), np.int64)
    n[full.to_numpy(zero_copy_only=False)] = pc.list_value_length(lists).to_numpy()
    words = lists.flatten()
    if len(words) and pc.max(pc.binary_length(words)).as_py() > LONG:
        words = pa.array([w if len(w) <= LONG else b"\x0b" + hashlib.sha256(w).hexdigest().encode() for w in words.cast(pa.binary()).to_pylist()],
                         pa.binary())
    return n, words.cast(pa.binary())


def joined(words: pa.Array) -> tuple[bytes, np.ndarray]:
    """The words with a space after each, and where each begins."""
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), b" ")[0].as_py() + b" "
    return text, np.concatenate([[0], np.cumsum(pc.binary_length(words).to_numpy().astype(np.int64) + 1)])


def packed(data: list[np.ndarray | bytes]) -> bytes:
    """Arrays and bytes, one after the other, each with its length, compressed."""
    import zstandard

    parts = [x if isinstance(x, bytes) else np.ascontiguousarray(x, np.int64).tobytes() for x in data]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(len(p).to_bytes(8, "little") + p for p in parts))


def unpacked(blob: bytes) -> list[memoryview]:
    import zstandard

    raw, at, out = memoryview(zstandard.ZstdDecompressor().decompress(blob)), 0, []
    while at < len(raw):
        n = int.from_bytes(raw[at:at + 8], "little")
        out.append(raw[at + 8:at + 8 + n])
        at += 8 + n
    return out


class Strings:
    """Packed strings of one task's documents: equal ones fold to the smallest doc."""

    def __init__(self, text: bytes, begin: np.ndarray, end: np.ndarray, doc: np.ndarray, mark: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.parts = [text[a:b] for a, b in zip(begin.tolist(), end.tolist())]
        self.doc, self.mark, self.first, self.last = doc, mark, first, last

    def rows(self, bucket: np.ndarray, n_buckets: int) -> Iterator[tuple]:
        """Rows of ``PACKED``: strings for their buckets, and ranges of words that a smaller doc here has as well."""
        if not self.parts:
            return
        code = pa.array(self.parts, pa.binary()).dictionary_encode().indices.to_numpy()
        least = np.full(code.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, code, self.doc)
        later = self.doc > least[code]
        if later.any():
            doc, mark, first, last = (x[later] for x in (self.doc, self.mark, self.first, self.last))
            new = np.ones(len(doc), bool)  # of one text in order: overlapping ones are one range
            new[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]) | (first[1:] > last[:-1]) | (first[1:] < first[:-1])
            at = np.nonzero(new)[0]
            end = last[np.append(at[1:], len(doc)) - 1]
            for i in range(0, len(at), ROW // 32):
                some = slice(i, i + ROW // 32)
                yield int(doc[at[i]] % n_buckets), RANGES, 0, packed([doc[at[some]], mark[at[some]], first[at[some]], end[some]])
        keep = np.nonzero(~later)[0]
        keep = keep[np.lexsort((keep, code[keep], bucket[keep]))]
        size = np.array([len(self.parts[i]) for i in keep.tolist()], np.int64)
        one = np.ones(len(keep), bool)  # the first place of each string
        one[1:] = code[keep[1:]] != code[keep[:-1]]
        held = np.cumsum(size * one)
        cut = np.ones(len(keep), bool)
        cut[1:] = one[1:] & ((bucket[keep[1:]] != bucket[keep[:-1]]) | (held[1:] // ROW != held[:-1] // ROW))
        bounds = np.append(np.nonzero(cut)[0], len(keep)).tolist()
        for a, b in zip(bounds, bounds[1:]):
            here, first = keep[a:b], one[a:b]
            text = b"".join([self.parts[i] for i in here[first].tolist()])
            yield (int(bucket[here[0]]), STRINGS, len(text),
                   packed([text, size[a:b][first], np.cumsum(first) - 1, np.diff(self.doc[here], prepend=0), self.mark[here], self.first[here]]))


def super_kmers(ids: np.ndarray, marks: np.ndarray, texts: pa.Array, k: int, m: int, n_buckets: int) -> Iterator[tuple]:
    """Rows of ``PACKED`` for some documents' texts."""
    n, words = word_lists(texts)
    if len(words) < k:
        return
    seen = words.dictionary_encode()
    import xxhash

    hashes = np.array([xxhash.xxh64_intdigest(w) for w in seen.dictionary.to_pylist()], np.uint64)[seen.indices.to_numpy()]
    doc = np.repeat(np.arange(len(n)), n)
    begins = np.cumsum(n) - n
    least = sliding_min(run_hashes(hashes, m), k - m + 1)
    size = len(words) - k + 1
    start = np.nonzero(doc[:size] == doc[k - 1:])[0]  # windows of one text
    if not len(start):
        return
    new = np.ones(len(start), bool)
    new[1:] = (doc[start[1:]] != doc[start[:-1]]) | (least[start[1:]] != least[start[:-1]])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(start)), 0))
    new |= (np.arange(len(start)) - lead) % RUN == 0
    at = np.nonzero(new)[0]
    first = start[at]
    last = start[np.append(at[1:], len(start)) - 1] + k  # the word after the string's last one
    text, offset = joined(words)
    row = doc[first]
    made = Strings(text, offset[first], offset[last], ids[row], marks[row], first - begins[row], last - begins[row])
    yield from made.rows((least[first] * _MIX >> np.uint64(33)).astype(np.int64) % n_buckets, n_buckets)


def _packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, kinds)], names=["bucket", "kind", "size", "data"])


class Bucket:
    """Strings of one bucket, as they come."""

    def __init__(self) -> None:
        self.blobs: list[bytes] = []
        self.size = 0

    def windows(self, k: int) -> tuple[np.ndarray, ...]:
        """doc, mark, first and last word of the ranges that windows with a smaller doc cover."""
        text, sizes, places, base = [], [], [], 0
        for blob in self.blobs:
            data, size, *place = unpacked(blob)
            place = [np.frombuffer(p, np.int64) for p in place]
            text.append(bytes(data))
            sizes.append(np.frombuffer(size, np.int64))
            places.append((place[0] + base, np.cumsum(place[1]), place[2], place[3]))
            base += len(sizes[-1])
        offset = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        string, doc, mark, begin = (np.concatenate(x) for x in zip(*places))
        own = np.zeros(base, np.int64)
        own[string] = doc  # all places of a string have its smallest doc
        # a string ends with a space: its words are as many as its spaces
        data = b"".join(text)
        space = np.nonzero(np.frombuffer(data, np.uint8) == 32)[0] + 1
        word_at = np.concatenate([[0], space]).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(space), [None, pa.py_buffer(word_at), pa.py_buffer(data)])
        codes = words.dictionary_encode().indices.to_numpy().astype(np.uint64)
        begins = np.searchsorted(word_at, offset)  # the first word of each string
        of = np.repeat(np.arange(base), np.diff(begins))
        start = np.nonzero(of[:len(of) - k + 1] == of[k - 1:])[0]
        small = self.smallest(codes, start, own[of[start]], k)
        hit = start[small < own[of[start]]]
        if not len(hit):
            return (np.zeros(0, np.int64),) * 4
        new = np.ones(len(hit), bool)
        new[1:] = (of[hit[1:]] != of[hit[:-1]]) | (hit[1:] != hit[:-1] + 1)
        at = np.nonzero(new)[0]
        s = of[hit[at]]
        lo, hi = hit[at] - begins[s], hit[np.append(at[1:], len(hit)) - 1] - begins[s] + k
        # to each place of the string
        order = np.argsort(string, kind="stable")
        n = np.bincount(string, minlength=base)
        head = np.cumsum(n) - n
        times = n[s]
        each = np.repeat(np.arange(len(s)), times)
        place = order[head[s[each]] + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
        return doc[place], mark[place], begin[place] + lo[each], begin[place] + hi[each]

    @staticmethod
    def smallest(codes: np.ndarray, start: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
        """The smallest doc that has each window: windows are sorted by hash, and neighbours of one hash compared word by word."""
        for seed in count():
            hashes = run_hashes(codes, k, seed)[start]
            order = np.argsort(hashes)
            same = np.zeros(len(order), bool)
            same[1:] = hashes[order[1:]] == hashes[order[:-1]]
            a, b = start[order[same]], start[order[np.nonzero(same)[0] - 1]]
            if all(np.array_equal(codes[a + j], codes[b + j]) for j in range(k)):
                break  # else two windows have one hash: another one parts them
        lead = np.nonzero(~same)[0]
        out = np.empty(len(order), np.int64)
        out[order] = np.repeat(np.minimum.reduceat(doc[order], lead), np.diff(np.append(lead, len(order)))) if len(order) else 0
        return out


def _meet(k: int, limit: int | None):
    """Rows of ``FOUND``: ranges, and strings of buckets past ``limit`` as they came."""
    def batch(ranges: tuple, left: list) -> pa.RecordBatch:
        n, m = len(ranges[0]), len(left)
        null = pa.nulls(m, pa.int64())
        cols = [pa.chunked_array([pa.array(r, pa.int64()), null]).combine_chunks() for r in ranges]
        size, data = zip(*left) if left else ((), ())
        cols.append(pa.chunked_array([pa.nulls(n, pa.int64()), pa.array(size, pa.int64())]).combine_chunks())
        cols.append(pa.chunked_array([pa.nulls(n, pa.binary()), pa.array(data, pa.binary())]).combine_chunks())
        return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in FOUND.split(", ")])

    nothing = (np.zeros(0, np.int64),) * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        now, held, over = None, Bucket(), False
        for b in batches:
            for bucket, kind, size, data in zip(*(c.to_pylist() for c in b.columns)):
                if kind == RANGES:
                    yield batch(tuple(np.frombuffer(x, np.int64) for x in unpacked(data)), [])
                    continue
                if bucket != now:
                    if held.blobs:
                        yield batch(held.windows(k), [])
                    now, held, over = bucket, Bucket(), False
                held.blobs.append(data)
                held.size += size
                if limit and held.size > limit or over:
                    over = True
                    yield batch(nothing, [(len(unpacked(x)[0]), x) for x in held.blobs])
                    held = Bucket()
        yield batch(held.windows(k) if held.blobs else nothing, [])

    return run


def _single_windows(k: int, n_buckets: int):
    """Strings of crowded buckets to rows of ``PACKED``, each window a string of its own."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob in b.column("data").to_pylist():
                data, size, *place = unpacked(blob)
                text = bytes(data)
                string, doc, mark, begin = (np.frombuffer(p, np.int64) for p in place)
                doc = np.cumsum(doc)
                offset = np.concatenate([[0], np.cumsum(np.frombuffer(size, np.int64))])
                word_at = np.concatenate([[0], np.nonzero(np.frombuffer(text, np.uint8) == 32)[0] + 1])
                begins = np.searchsorted(word_at, offset)
                n = np.diff(begins)[string] - k + 1  # windows of each place
                each = np.repeat(np.arange(len(string)), n)
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                word = begins[string[each]] + inside
                first = begin[each] + inside
                order = np.lexsort((first, mark[each], doc[each]))
                made = Strings(text, word_at[word[order]], word_at[word[order] + k], doc[each][order], mark[each][order], first[order], first[order] + k)
                at = np.array([xxhash.xxh64_intdigest(p) % n_buckets for p in made.parts], np.int64)
                for row in made.rows(at, n_buckets):
                    yield _packed_batch([row])

    return run


def _exchange(rows: DataFrame, n_buckets: int) -> DataFrame:
    parts = min(n_buckets, PARTITIONS)
    return rows.repartitionById(parts, (F.col("bucket") % parts).cast("int")).sortWithinPartitions("bucket")


def marks(df: DataFrame, doc: Column, text: Column) -> Column:
    """What tells rows of one id apart: a hash of the text where the id may be repeated, else 0.

    A map of fixed size says which ids may be; where it errs, a hash travels that need not.
    """
    slot = F.pmod(F.xxhash64(doc), F.lit(MAP))
    twice = df.select(doc.alias("doc")).where("doc IS NOT NULL").groupBy("doc").count().where("count > 1")
    hit = [r[0] for r in twice.select(F.pmod(F.xxhash64("doc"), F.lit(MAP)).alias("slot")).distinct().collect()]  # MAP rows at most
    if not hit:
        return F.lit(0).cast("long")
    flags = np.zeros(MAP, np.uint8)
    flags[hit] = 1
    return F.when(F.substr(F.lit(bytearray(flags.tobytes())), (slot + 1).cast("int"), F.lit(1)) == F.lit(bytearray(b"\x01")), F.xxhash64(text)).otherwise(0)


def repeated_ranges(docs: DataFrame, k: int = 13, m: int = 4, target: int = TARGET, limit: int = LIMIT) -> DataFrame:
    """doc, mark, ranges (array of first, last): words of each document under windows that a smaller doc has as well.

    ``docs``: doc long, mark long, text string. Ranges may overlap; ``last`` is the word after a range.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    overlap = 1 + 2 * (k - 1) / (k - m + 2)  # words that travel for each word
    n_buckets = int(min(size * overlap // target + 1, 2**31 - 1))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                rows: list[tuple] = []
                held = 0
                for row in super_kmers(b.column("doc").to_numpy(), b.column("mark").to_numpy(), b.column("text"), k, m, n_buckets):
                    rows.append(row)
                    held += len(row[3])
                    if held > 4 * ROW:
                        yield _packed_batch(rows)
                        rows, held = [], 0
                yield _packed_batch(rows)

    strings = docs.where("doc IS NOT NULL").select("doc", "mark", "text").mapInArrow(cut, PACKED)
    found = materialize(_exchange(strings, n_buckets).mapInArrow(_meet(k, limit), FOUND), "windows")
    ranges = found.where("doc IS NOT NULL")
    left = found.where("data IS NOT NULL").select("size", "data")
    crowded = left.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if crowded:
        again = int(min(crowded * k // target + 1, 2**31 - 1))
        single = left.select("data").mapInArrow(_single_windows(k, again), PACKED)
        more = materialize(_exchange(single, again).mapInArrow(_meet(k, None), FOUND), "windows")
        ranges = ranges.unionByName(more.where("doc IS NOT NULL"))
    return materialize(ranges.groupBy("doc", "mark").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "ranges")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "repeats", k: int = 13, m: int = 4,
                   target: int = TARGET, limit: int = LIMIT, keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) and a struct ``out``: n_words, n_removed and kept, the words left joined by one space.

    A word goes if a window of ``k`` words over it starts in a document with a smaller id as well; windows are those of
    the input, not of what is left. Words are parted by ASCII white space. Ids are integers; a row
    without an id neither loses words nor makes others lose any. Rows of one id are not smaller than each other, so
    repeated rows stay alike. Null and empty texts have no words; texts shorter than ``k`` words have no window. An
    empty table gives an empty result. A column named ``out`` is replaced; other columns pass through.
    """
    names = [c for c in (df.columns if keep is None else keep) if c != out]
    doc, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    mark = marks(df, doc, text)
    ranges = repeated_ranges(df.select(doc.alias("doc"), mark.alias("mark"), text.alias("text")), k, m, target, limit)
    row = df.select(doc.alias("doc"), mark.alias("mark"), text.alias("text"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    both = row.join(ranges, ["doc", "mark"], "left").select("text", "ranges", "row")
    fields = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    schema = T.StructType([T.StructField("row", both.schema["row"].dataType), T.StructField("made", fields)])

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                n, gone, kept = [], [], []
                for raw, cover in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("ranges").to_pylist()):
                    words = raw.split() if raw else []
                    n.append(len(words))
                    if cover:
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, [r["first"] for r in cover], 1)
                        np.add.at(edge, [r["last"] for r in cover], -1)
                        words = [words[i] for i in np.nonzero(np.cumsum(edge[:-1]) == 0)[0].tolist()]
                    gone.append(n[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                made = pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                                  names=["n_words", "n_removed", "kept"])
                yield pa.RecordBatch.from_arrays([b.column("row"), made], names=["row", "made"])

    return both.mapInArrow(strip, schema).select("row.*", F.col("made").alias(out))
