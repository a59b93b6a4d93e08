"""Documents to files of token ids and back.

Ids are made where the texts are read; what is exchanged, once, is the
compressed ids. Each part holds a range of doc_id in ascending order and
becomes one file of ``simple8b``. The manifest, written after the files, says
which files count.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, shared_path, slices, worker_state
from tessera.llm.idpool import IdPool, by_group

REMEMBERED = 160_000
#: The vocabulary's pattern for lower-case ASCII and the UTF-8 bytes of Latin letters up to U+024F.
LATIN_WORDS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xc3-\xc9\x80-\xbf]+|[0-9]|[^\s0-9a-z\xc3-\xc9\x80-\xbf]+")
#: Bytes of ASCII and those letters; the two signs between them, and the letter that folds to two characters.
LATIN_BYTES = bytes([*range(0x80), *range(0x80, 0xC0), *range(0xC3, 0xCA)])
NOT_LATIN = (b"\xc3\x97", b"\xc3\xb7", b"\xc4\xb0")


def byte_chars() -> dict[int, str]:
    """The character that stands for each byte before the merges: printable Latin-1 for itself, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}}


class WordEncoder:
    """The tokenizers library behind a memory of pieces.

    The vocabulary's pattern never spans white space, so that a text is the
    sequence of its chunks between ASCII white space, each encoded once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # added tokens are found in the text as it is, before normalisation
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word or t.content.split() != [t.content] for t in added):
            raise ValueError("added tokens must be found in the text as it is, and hold no white space")
        self.added = [t.content.encode() for t in added]
        self.added_here = False
        self.merge = self.tokenizer.model.tokenize
        # letters in the Latin blocks, as decoded from Latin-1: their UTF-8 bytes as the model's characters
        self.chars = str.maketrans({chr(b): c for b, c in byte_chars().items()})
        self.chunks, self.pieces = IdPool(REMEMBERED), IdPool(REMEMBERED)

    def learn_pieces(self, new: list[bytes | str], at_once: int = 5000) -> None:
        """A word of Latin letters is left as it is by normalisation, but for its case: it goes to the library's merges
        at once. All others go through the library's whole path."""
        plain, letters, rest = [], [], []
        for p in new:
            if isinstance(p, bytes) and p.isalpha():  # letters of ASCII, in lower case from the chunk
                plain.append(p)
                letters.append(p.decode())
                continue
            low = p.decode().lower() if isinstance(p, bytes) else ""
            if low.isalpha():
                plain.append(p)
                letters.append(low if low.isascii() else low.encode().decode("latin-1").translate(self.chars))
            else:
                rest.append(p)
        got = [[t.id for t in self.merge(x)] for x in letters]
        self.pieces.add(plain, np.fromiter(chain.from_iterable(got), np.int32), np.fromiter(map(len, got), np.int64, len(got)))
        for i in range(0, len(rest), at_once):
            part = rest[i:i + at_once]
            got = self.tokenizer.encode([p if isinstance(p, str) else p.decode() for p in part], is_pretokenized=True, add_special_tokens=False)
            size = np.bincount(np.array(got.word_ids, np.int64), minlength=len(part))
            self.pieces.add(part, np.array(got.ids, np.int32), size)

    def learn_chunks(self, new: list[bytes]) -> None:
        """Latin chunks are cut by the pattern; any other, and one that holds an added token, is one piece for the library."""
        times, over, dotted = NOT_LATIN
        split = [LATIN_WORDS.findall(c.lower()) if c.isascii() or not (c.translate(None, LATIN_BYTES) or times in c or over in c or dotted in c)
                 else [c.decode()] for c in new]
        if self.added_here:
            split = [[c.decode()] if any(x in c for x in self.added) else s for c, s in zip(new, split)]
        flat, size = self.pieces.gather(list(chain.from_iterable(split)), self.learn_pieces)
        self.chunks.add(new, flat, by_group(size, list(map(len, split))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each text's."""
        self.chunks.trim()
        self.pieces.trim()
        texts = pc.fill_null(texts, "")
        # capitals of ASCII fold alike before and after normalisation, unless a combining mark follows; where a text has an
        # added token in some case, its chunks keep theirs
        marks = pc.match_substring_regex(texts, "[\u0300-\u036f]")
        low = pc.ascii_lower(texts)
        self.added_here = False
        for token in self.added:
            there = pc.match_substring(low, token.lower().decode())
            if pc.any(there).as_py():
                marks, self.added_here = pc.or_(marks, there), True
        cut = pc.ascii_split_whitespace(pc.if_else(marks, texts, low) if pc.any(marks).as_py() else low)
        ids, size = self.chunks.gather_array(cut.flatten().cast(pa.binary()), self.learn_chunks)
        return ids, by_group(size, pc.list_value_length(cut).to_numpy())


def encoder(path: str) -> WordEncoder:
    return worker_state(("words", path), lambda: WordEncoder(path))


class Parts:
    """Which part a row goes to: ranges of ids of like size. An id that fills several ranges, and null, has as many parts of its
    own, dealt by a hash of the text. From the id column alone."""

    def __init__(self, df: DataFrame, id_col: str, parts: int):
        at = [i / parts for i in range(1, parts)]
        row = df.select(F.count(F.lit(1)), F.count(f"`{id_col}`"), *([F.percentile_approx(f"`{id_col}`", at, 100 * parts)] if at else [F.lit(None)])).first()
        self.nulls = -(-parts * (row[0] - row[1]) // row[0]) if row[0] else 0
        self.bounds, self.copies = np.unique(np.array(row[2] or [], np.int64), return_counts=True)
        self.first = self.nulls + 1 + np.cumsum(self.copies) - self.copies
        self.n = int(self.nulls + 1 + self.copies.sum())

    def of(self, doc: int | None, text_hash: int) -> int:
        if doc is None:
            return text_hash % self.nulls
        i = int(np.searchsorted(self.bounds, doc, side="right")) - 1
        if i < 0:
            return self.nulls
        n = int(self.copies[i])
        return int(self.first[i]) + (text_hash % n if doc == self.bounds[i] else n - 1)


def write_ids(df: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
              parts: int | None = None) -> DataFrame:
    """Write the ids of every text and ``end_id`` after it, ascending by id; return the manifest (part, path, n_docs, n_ids).

    Ids are integers (other types are cast, and one that is no number is an
    error). Null ids come first, null and empty texts have the end id alone,
    repeated ids keep all rows, shorter ones first within a part; an id, or
    null, that very many rows have is spread over several parts. An empty
    table writes no file.
    """
    import zstandard

    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    where = Parts(made, "id", parts)
    folder = shared_path(spark, "ids")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, zip_ = encoder(tokenizer_path), zstandard.ZstdCompressor(level=1)
        for whole in batches:
            for b in slices(whole, "text"):
                flat, counts = enc.encode(b.column("text"))
                ends = np.cumsum(counts)
                docs = b.column("id").to_pylist()
                packed = [zip_.compress(np.append(flat[e - n:e], end_id).astype("<u4" if end_id > 65535 or n and flat[e - n:e].max() > 65535 else "<u2").tobytes())
                          for e, n in zip(ends.tolist(), counts.tolist())]
                part = [where.of(d, h) for d, h in zip(docs, b.column("hash").to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(docs, pa.int64()), pa.array(counts + 1, pa.int64()),
                                                  pa.array(packed, pa.binary())], names=["part", "id", "n", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tessera.llm.simple8b import Writer

        unzip, out, now, rows = zstandard.ZstdDecompressor(), None, None, []

        def close() -> None:
            if out:
                out.close()
                rows.append((now, out.path, len(out.docs), out.n_ids))

        for b in batches:
            for part, doc, n, raw in zip(*(c.to_pylist() for c in b.columns)):
                if part != now:
                    close()
                    out, now = Writer(folder), part
                data = unzip.decompress(raw)
                out.add(doc, np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4"))
        close()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, (pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                                         names=["part", "path", "n_docs", "n_ids"])

    made = made.withColumn("hash", F.xxhash64("text")).mapInArrow(make, "part int, id long, n long, ids binary")
    ordered = made.repartitionById(where.n, F.col("part")).sortWithinPartitions("part", F.col("id").asc_nulls_first(), "n")
    return materialize(ordered.mapInArrow(write, "part int, path string, n_docs long, n_ids long"), "manifest")


def read_ids(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files of a manifest."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tessera.llm.simple8b import Reader

        kinds = (pa.int64(),) * 4
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("before").to_pylist()):
                rows: list = []
                for doc, at, n, crc in Reader(path).documents():
                    rows.append((doc, start + at, n, crc))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = manifest.count()
    return files.select("path", "before").repartition(max(1, n)).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
