"""Byte-level BPE in DuckDB: a recursive query over each partition's words.

Texts are cut into words by the vocabulary's pattern. Words not seen before
become token-position rows; each step of the recursive query joins them with
the merge table and contracts the leftmost pair of minimum rank of each word,
until no word has a pair left. Words are cut beforehand where no token spans
two bytes, and a long word has its best pair contracted wherever it stands, so
that a word of a million bytes takes seconds. Decoding joins the ids with the vocabulary and
concatenates in order.

The connection, its tables and the words seen stay with the Python worker; a
task that is run again elsewhere builds them anew from the vocabulary file.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import add_struct, worker_state
from tessera.llm.idpool import IdPool

#: Words and chunks in each of the two generations that a worker remembers, and words that one query contracts.
REMEMBERED, AT_ONCE = 160_000, 50_000
#: Pieces contracted together, and texts decoded together, hold about so many bytes: a worker's peak is that of these two queries.
BYTES_AT_ONCE, TEXT_AT_ONCE = 1 << 18, 1 << 20

#: Words beyond so many bytes have all disjoint places of their best pair contracted in a step, others the leftmost one.
LONG = 64

#: The best pair of each word at its leftmost place; ``top`` is the highest rank that the word took.
CONTRACT = """
WITH RECURSIVE words(w, ids, done, top) AS (
    SELECT w, list(id ORDER BY pos), false, -1 FROM positions GROUP BY w
  UNION ALL (
    WITH p AS (
        SELECT w, unnest(ids) AS id, unnest(ids[2:] || [-1]) AS next, generate_subscripts(ids, 1) AS pos
        FROM words WHERE NOT done),
    best AS (
        SELECT p.w, min(m.rank::BIGINT << 32 | p.pos) AS k
        FROM p JOIN merges AS m ON p.id = m.l AND p.next = m.r GROUP BY p.w)
    SELECT words.w,
           CASE WHEN k IS NULL THEN ids
                ELSE ids[:(k & 4294967295) - 1] || [(k >> 32)::INTEGER] || ids[(k & 4294967295) + 2:] END,
           k IS NULL, greatest(top, (k >> 32)::INTEGER)
    FROM words LEFT JOIN best ON words.w = best.w WHERE NOT words.done))
SELECT w, ids, top FROM words WHERE done ORDER BY w
"""
#: The best pair of each word at all places: of places that follow each other directly the first, third, fifth ...
CONTRACT_LONG = """
WITH RECURSIVE words(w, ids, done) AS (
    SELECT w, list(id ORDER BY pos), false FROM positions GROUP BY w
  UNION ALL (
    WITH p AS (
        SELECT w, unnest(ids) AS id, unnest(ids[2:] || [-1]) AS next, generate_subscripts(ids, 1) AS pos
        FROM words WHERE NOT done),
    pairs AS (SELECT p.w, p.pos, m.rank FROM p JOIN merges AS m ON p.id = m.l AND p.next = m.r),
    best AS (SELECT w, min(rank) AS rank FROM pairs GROUP BY w),
    places AS (
        SELECT w, pos, rank, pos - row_number() OVER (PARTITION BY w ORDER BY pos) AS run
        FROM pairs JOIN best USING (w, rank)),
    taken AS (
        SELECT w, pos, rank FROM places
        QUALIFY row_number() OVER (PARTITION BY w, run ORDER BY pos) % 2 = 1),
    joined AS (
        SELECT p.w, p.pos, coalesce(taken.rank, p.id) AS id, taken.rank IS NOT NULL AS first
        FROM p LEFT JOIN taken ON taken.w = p.w AND taken.pos = p.pos),
    second AS (SELECT w, pos + 1 AS pos FROM taken)
    SELECT w, list(id ORDER BY pos), NOT bool_or(first) FROM joined ANTI JOIN second USING (w, pos) GROUP BY w))
SELECT w, ids FROM words WHERE done ORDER BY w
"""
DECODE = """
SELECT d, unhex(string_agg(v.hex, '' ORDER BY t.pos)) AS bytes
FROM tokens AS t JOIN vocabulary AS v USING (id) GROUP BY d
"""


class DuckBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks_path: str, pattern: str):
        import duckdb
        import regex

        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        # the pattern's white space is Unicode's, as in the reference encoder
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.pieces, self.chunks = IdPool(REMEMBERED), IdPool(REMEMBERED)
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        rows = [(le, ri, m) for tok, m in self.ranks.items() for i in range(1, len(tok))
                if (le := self.ranks.get(tok[:i])) is not None and (ri := self.ranks.get(tok[i:])) is not None]
        merges = pa.table([pa.array(c, pa.int32()) for c in zip(*rows)], names=["l", "r", "rank"])  # noqa: F841 (read by name)
        vocabulary = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "hex": [t.hex() for t in self.ranks]})  # noqa: F841
        self.con.execute("CREATE TABLE merges AS FROM merges")
        self._ordered: bool | None = None
        self.inside = np.zeros((256, 256), bool)
        for tok in self.ranks:
            for a, b in zip(tok, tok[1:]):
                self.inside[a, b] = True
        self.con.execute("CREATE TABLE vocabulary AS FROM vocabulary")

    def contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has, by the recursive queries.

        Words are cut first between two bytes that follow each other in no
        token, since no merge spans such a place.
        """
        raw = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum([0, *map(len, words)])[:-1]
        cut = np.ones(len(raw), bool)
        cut[1:] = ~self.inside[raw[:-1], raw[1:]]
        cut[starts] = True
        firsts = np.nonzero(cut)[0]
        lens = np.diff(np.append(firsts, len(raw)))
        long = lens > LONG
        parts = [(nums, query) for nums, query in ((np.nonzero(~long)[0], CONTRACT), (np.nonzero(long)[0], CONTRACT_LONG)) if len(nums)]
        if long.any() and not self.ordered():
            parts = [(np.arange(len(lens)), CONTRACT)]
        got = [self._contracted(raw, firsts[nums], lens[nums], nums, query) for nums, query in parts]
        size = np.zeros(len(lens), np.int64)
        for (nums, _), (_, n) in zip(parts, got):
            size[nums] = n
        ends = np.cumsum(size)
        ids = np.empty(ends[-1], np.int32)
        for (nums, _), (flat, n) in zip(parts, got):
            ids[np.repeat(ends[nums] - size[nums] - (np.cumsum(n) - n), n) + np.arange(len(flat))] = flat
        return ids, np.add.reduceat(size, np.cumsum(cut)[starts] - 1)

    def _contracted(self, raw: np.ndarray, starts: np.ndarray, lens: np.ndarray, nums: np.ndarray, query: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of the words ``nums``, which lie in ``raw`` at ``starts``, by one of the queries."""
        within = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
        positions = pa.table({  # noqa: F841 (read by name)
            "w": np.repeat(nums.astype(np.int32), lens), "pos": within.astype(np.int32),
            "id": self.byte_id[raw[np.repeat(starts, lens) + within]]})
        got = self.con.sql(query).to_arrow_table().column("ids").combine_chunks()
        return got.flatten().to_numpy(), pc.list_value_length(got).to_numpy()

    def ordered(self) -> bool:
        """Whether each token's own bytes contract to it by ranks up to its own.

        Then the ranks that a word takes never fall: a contraction that made a
        pair of a lower rank would stand in that lower token's own contraction.
        All disjoint places of a word's best pair may so be contracted at once.
        """
        if self._ordered is None:
            tokens = sorted((t for t in self.ranks if len(t) > 1), key=len)
            lens = np.array([len(t) for t in tokens])
            raw = np.frombuffer(b"".join(tokens), np.uint8)
            positions = pa.table({  # noqa: F841 (read by name)
                "w": np.repeat(np.arange(len(tokens), dtype=np.int32), lens),
                "pos": (np.arange(len(raw)) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int32), "id": self.byte_id[raw]})
            got = self.con.sql(f"SELECT len(ids) AS n, ids[1] AS id, top FROM ({CONTRACT}) ORDER BY w").to_arrow_table()
            own = np.array([self.ranks[t] for t in tokens])
            n, ids, top = (got.column(c).to_numpy() for c in ("n", "id", "top"))
            self._ordered = bool((n == 1).all() and (ids == own).all() and (top == own).all())
        return self._ordered

    def learn_pieces(self, new: list[str]) -> None:
        """A token of its own, or the contracted bytes."""
        raw = {p: p.encode() for p in new}
        whole = [p for p, r in raw.items() if r in self.ranks]
        self.pieces.add(whole, np.array([self.ranks[raw.pop(p)] for p in whole], np.int32), np.ones(len(whole)))
        todo = sorted(raw.items(), key=lambda x: len(x[1]))  # words of like length end together
        at = 0
        while at < len(todo):
            end, held = at, 0
            while end < len(todo) and end - at < AT_ONCE and (end == at or held + len(todo[end][1]) <= BYTES_AT_ONCE):
                held += len(todo[end][1])
                end += 1
            self.pieces.add([p for p, _ in todo[at:end]], *self.contract([r for _, r in todo[at:end]]))
            at = end

    def learn_chunks(self, new: list) -> None:
        """Ids of chunks; none for a chunk that is not a place of its own (see ``encode``)."""
        split: dict = {}
        odd: list = []
        for c in new:
            if isinstance(c, bytes):
                core = whole = c.decode()
            else:
                core, whole = (c[1:], c) if c[:1] == "\n" else (c, " " + c)
            if not core or core[0].isspace() or core[-1].isspace():
                odd.append(c)
            else:
                split[c] = self.split(whole)
        self.chunks.add(odd, np.zeros(0, np.int32), np.zeros(len(odd)))
        if split:
            flat, size = self.pieces.gather(list(chain.from_iterable(split.values())), self.learn_pieces)
            self.chunks.add(list(split), flat, np.add.reduceat(size, np.cumsum([0, *map(len, split.values())])[:-1]))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each text's.

        A text is cut before single spaces and line ends that stand between two
        other characters. No match of the pattern spans such a place, so that
        chunks can be encoded once each. A text with other runs of white space
        is split as a whole.
        """
        self.pieces.trim()
        self.chunks.trim()
        cut: list[list] = []
        for t in texts:
            c: list = t.replace("\n", " \n").split(" ") if t else []
            if c:
                c[0] = c[0].encode()  # bytes: no space before it
            cut.append(c)
        ids, size = self.chunks.gather(list(chain.from_iterable(cut)), self.learn_chunks)
        bounds = np.cumsum([0, *map(len, cut)])
        total = np.concatenate([[0], np.cumsum(size)])[bounds]
        odd = np.unique(np.searchsorted(bounds, np.nonzero(size == 0)[0], side="right") - 1)
        if not len(odd):
            return ids, np.diff(total)
        parts = [ids[a:b] for a, b in zip(total[:-1], total[1:])]
        for i in odd.tolist():
            parts[i], _ = self.pieces.gather(self.split(texts[i]), self.learn_pieces)
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Bytes of each text from its ids, by ordered aggregation."""
        starts = np.cumsum(counts) - counts
        tokens = pa.table({"d": np.repeat(np.arange(len(counts), dtype=np.int32), counts),  # noqa: F841 (read by name)
                           "pos": (np.arange(len(ids)) - np.repeat(starts, counts)).astype(np.int32), "id": ids.astype(np.int32)})
        out = [b""] * len(counts)
        got = self.con.sql(DECODE).to_arrow_table()
        for d, b in zip(got.column("d").to_pylist(), got.column("bytes").to_pylist()):
            out[d] = b
        return out


def codec(ranks_path: str, pattern: str) -> DuckBpe:
    return worker_state(("bpe", ranks_path, pattern), lambda: DuckBpe(ranks_path, pattern))


def _ids_of(texts: list, ranks_path: str, pattern: str) -> tuple[DuckBpe, np.ndarray, np.ndarray]:
    bpe = codec(ranks_path, pattern)
    return bpe, *bpe.encode(texts)


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out: str = "bpe") -> DataFrame:
    """``df`` and a struct ``out`` with ``ids`` of the whole text. Null and empty texts have none."""
    def make(texts: list) -> dict[str, list]:
        _, ids, counts = _ids_of(texts, ranks_path, pattern)
        return {"ids": [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]}

    return add_struct(df, text_col, out, T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))]), make, as_bytes=False, stateful=True, limit=TEXT_AT_ONCE)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` and a struct ``out`` with ``bytes`` of the ids (null ids: empty). An id that is not in the vocabulary is an error."""
    make_one: Callable = lambda values: [np.array(v or [], np.int32) for v in values]

    def make(values: list) -> dict[str, list]:
        bpe, arrays = codec(ranks_path, pattern), make_one(values)
        if any(len(a) and (a.min() < 0 or a.max() >= len(bpe.ranks)) for a in arrays):
            raise ValueError("an id is not in the vocabulary")
        return {"bytes": bpe.decode(np.concatenate(arrays), np.array([len(a) for a in arrays]))}

    return add_struct(df, ids_col, out, T.StructType([T.StructField("bytes", T.BinaryType())]), make, as_bytes=False, stateful=True, limit=TEXT_AT_ONCE)


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out: str = "bpe",
               keep: list[str] | None = None) -> DataFrame:
    """``df`` and a struct ``out``: n_tokens, ids_sha256 (ids as little-endian 32-bit integers), decoded_sha256.

    The ids are decoded again in the same pass and need not leave the task.
    Null and empty texts have no ids and the digests of nothing; repeated rows
    are returned each; an empty table gives an empty one; a column named
    ``out`` is replaced, all others stay.
    """
    fields = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])

    def make(texts: list) -> dict[str, list]:
        bpe, ids, counts = _ids_of(texts, ranks_path, pattern)
        ends, raw = np.cumsum(counts).tolist(), memoryview(ids.astype("<u4").tobytes())
        starts = [0, *ends[:-1]]
        return {"n_tokens": counts.tolist(),
                "ids_sha256": [hashlib.sha256(raw[4 * s:4 * e]).hexdigest() for s, e in zip(starts, ends)],
                "decoded_sha256": [hashlib.sha256(b).hexdigest() for b in bpe.decode(ids, counts)]}

    return add_struct(df, text_col, out, fields, make, keep=keep, as_bytes=False, stateful=True, limit=TEXT_AT_ONCE)
