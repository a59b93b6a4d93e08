"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so that a question whose
values were changed keeps its template. Names are told by their capital, which
a text that lost its punctuation or case does not have where the item has it;
so every text is read with names as placeholders and as plain words. A capital
that begins a sentence may be a name or not; a further form takes every capital
as one. Where it is asked for, texts are read
word for word too, for items that have too few literals for a template. Windows of a form's tokens
are hashed and joined with the benchmark's windows of that form; where an item is
dense in values, its window is widened until it holds enough literals. Along each
alignment of a document with an item the slots are compared: one benchmark value
must stand for one document value. What covers enough of an item is a leak.

A bit map of the benchmark's window hashes, of a fixed size, goes to the tasks
that read the documents; only windows that it lets through are exchanged. The
hash join that follows is exact at any size of the benchmark.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name, materialize, slices, utf8, worker_state

LITERAL, NUMBER, UNIT, CAPITAL, NAME = range(5)
#: Forms in which texts are read: names as placeholders, names as words, capitals that begin a sentence as names too.
FORMS = (0, 1, 2)
#: The form without placeholders, in which numbers, units and names are compared as they are.
EXACT = 9
# Words that stand for numbers and units.
NUMBERS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
                    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
UNITS = frozenset("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces lb lbs "
                  "pound pounds ton tons ml litre litres liter liters gallon gallons cup cups second seconds minute minutes hour hours "
                  "day days week weeks month months year years cent cents dollar dollars euro euros usd eur percent degree degrees "
                  "mph kmh meter meters metre metres kilometer kilometers kilometre kilometres".split())
KINDS = {**dict.fromkeys(UNITS, UNIT), **dict.fromkeys(NUMBERS, NUMBER)}
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*[a-z%]{0,3}")
#: Chunks that a worker remembers; past it they are forgotten, which costs time only.
REMEMBERED = 150_000
#: A window's first token and its length as one number.
PLACE = 1 << 24
#: Each step of a widened window is half as long again.
WIDEN = 1.5
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
#: Settings of the query and the pipeline, which look for every leak.
WHOLE = {"partial": True, "exact": True}


class Canon:
    """Words to template tokens, with a memory of the chunks seen."""

    def __init__(self) -> None:
        import xxhash

        self.hash = xxhash.xxh64_intdigest
        #: Hash of each placeholder; a literal has its own.
        self.typed = np.array([0, *(self.hash(f"<{k}>") for k in ("number", "unit", "capital", "name"))], np.uint64)
        self.powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))
        self.forget()

    def windows(self, hashes: np.ndarray, form: int) -> WindowHashes:
        if len(self.powers[0]) <= len(hashes):
            up = np.full(len(hashes) * 5 // 4 + 1, _BASE, np.uint64)
            down = np.full(len(up), pow(_BASE, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self.powers = (np.cumprod(up), np.cumprod(down))
        return WindowHashes(hashes, form, *self.powers)

    def forget(self) -> None:
        self.code: dict[bytes, int] = {}
        self.words: list[str] = []
        self.arrays = (np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, bool))

    def learn(self, new: list[bytes]) -> None:
        chunks = b"\n".join(new).decode().split("\n")  # a chunk holds no white space of ASCII
        words, ends = chunks, [False] * len(chunks)
        if odd := [i for i, ok in enumerate(map(str.isalpha, chunks)) if not ok]:
            words = chunks.copy()
            for i in odd:
                c = chunks[i]
                if c[-1:] in (".", ",") and c[:-1].isalpha():
                    words[i], ends[i] = c[:-1], c[-1] == "."
                else:
                    words[i] = c.strip("".join({x for x in c if not x.isalnum()}))
                    ends[i] = bool(set(c[len(c.rstrip(".!?:;\"')]")):]) & set(".!?:;"))
        lows = "\n".join(words).lower().split("\n")
        kinds = [LITERAL if k is None else k for k in map(KINDS.get, lows)]
        for i in odd:
            if not words[i]:
                kinds[i] = -1
            elif kinds[i] == LITERAL and not words[i].isalpha() and _NUMBER.fullmatch(lows[i]):
                kinds[i] = NUMBER
        for i, (word, low) in enumerate(zip(words, lows)):
            # a word all in capitals says nothing about names
            if word != low and kinds[i] == LITERAL and word[0].isupper() and word != word.upper():
                kinds[i] = CAPITAL
        self.code.update(zip(new, range(len(self.words), len(self.words) + len(new))))
        self.words += lows
        fresh = (np.fromiter(map(self.hash, lows), np.uint64, len(lows)), np.array(kinds, np.int8), np.array(ends, bool))
        self.arrays = tuple(np.concatenate(x) for x in zip(self.arrays, fresh))

    def forms(self, texts: pa.Array | list[bytes | None]) -> list[tuple[np.ndarray, ...]]:
        """All forms of ``each_form`` at once."""
        return list(self.each_form(texts))

    def each_form(self, texts: pa.Array | list[bytes | None]) -> Iterator[tuple[np.ndarray, ...]]:
        """All forms of all texts, in the order of ``FORMS``, ``EXACT`` last, made one by one. A form has each token's text number, template hash and
        kind, all words' chunks, each token's first word and the number of words that it spans.

        With names, a capital after a sentence's end or at the start is a literal;
        elsewhere it is a name, and names side by side are one token. In the further
        form every capital is a name; a sentence's end parts names.
        """
        if len(self.code) > REMEMBERED:
            self.forget()
        if isinstance(texts, list):
            texts = pa.array(texts, pa.binary()).cast(pa.string())
        cut = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
        found = cut.flatten().cast(pa.binary()).dictionary_encode()
        own = found.dictionary.to_pylist()
        if new := [c for c in own if c not in self.code]:
            self.learn(new)
        codes = np.fromiter(map(self.code.__getitem__, own), np.int64, len(own))[found.indices.to_numpy()]
        doc = np.repeat(np.arange(len(texts)), pc.list_value_length(cut).to_numpy())
        hashes, kinds, ends = (a[codes] if len(codes) else a[:0] for a in self.arrays)
        first = np.ones(len(codes), bool)
        first[1:] = (doc[1:] != doc[:-1]) | ends[:-1]
        word = kinds >= 0
        sentence = np.cumsum(first)[word]
        doc, hashes, kinds, codes, first = doc[word], hashes[word], kinds[word], codes[word], first[word]
        plain = np.where(kinds == CAPITAL, LITERAL, kinds)
        each = np.arange(len(codes))
        one = np.ones(len(codes), np.int64)

        def named(literal: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, ...]:
            kind = np.where(kinds == CAPITAL, np.where(literal, LITERAL, NAME), kinds)
            lead = np.ones(len(codes), bool)
            lead[1:] = (kind[1:] != NAME) | (kind[:-1] != NAME) | (part[1:] != part[:-1])
            at = np.nonzero(lead)[0]
            span = np.diff(np.append(at, len(codes)))
            return doc[at], np.where(kind == LITERAL, hashes, self.typed[kind])[at], kind[at], codes, at, span

        yield named(first, doc)
        yield doc, np.where(plain == LITERAL, hashes, self.typed[plain]), plain, codes, each, one
        yield named(np.zeros(len(codes), bool), sentence)
        yield doc, hashes, np.full(len(codes), LITERAL, np.int8), codes, each, one

    def slots(self, kinds: np.ndarray, codes: np.ndarray, at: np.ndarray, span: np.ndarray, i: int, n: int) -> list[str]:
        """Values of the placeholders of the window of ``n`` tokens at ``i``: offset and text, units without a plural s."""
        out = []
        for j in range(n):
            if (kind := kinds[i + j]) != LITERAL:
                value = " ".join(self.words[c] for c in codes[at[i + j]:at[i + j] + span[i + j]])
                out.append(f"{j}:{value.rstrip('s') if kind == UNIT else value}")
        return out


class WindowHashes:
    """64-bit hashes of windows of a form's tokens: differences of one running sum, whatever the window's length."""

    def __init__(self, hashes: np.ndarray, form: int, up: np.ndarray, down: np.ndarray):
        size = len(hashes) + 1
        self.form, self.down = form, down
        self.sums = np.zeros(size, np.uint64)
        np.cumsum(hashes * up[:size - 1], out=self.sums[1:])

    def of(self, n: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Of the windows of ``n`` tokens, those that begin ``at``."""
        if len(self.sums) <= n:
            return np.zeros(0, np.uint64)
        out = (self.sums[n:][at] - self.sums[:-n][at]) * self.down[:len(self.sums) - n][at]
        out ^= np.uint64((16 * n + self.form) * 0x9E3779B97F4A7C15 % 2**64)
        out ^= out >> np.uint64(32)
        out *= _MIX
        out ^= out >> np.uint64(29)
        return out


def canon() -> Canon:
    return worker_state(("canon",), Canon)


def literals(kinds: np.ndarray) -> np.ndarray:
    """Literals before each token, and in all."""
    return np.concatenate([[0], np.cumsum(kinds == LITERAL)])


def widths(kinds: np.ndarray, width: int, least: int) -> list[tuple[int, int]]:
    """(first token, length) of an item's windows: ``width`` tokens, widened step by step until ``least`` are literals.

    The last one of its length that fits ends with the item, too. An item shorter than ``width`` is one window, of
    literals if it has fewer than ``least`` tokens; so is one in which no step fits.
    """
    size, before = len(kinds), literals(kinds)
    least = min(least, size)
    if not size or before[-1] < least:
        return []
    out = []
    for i in range(size):
        n = width
        while i + n <= size and before[i + n] - before[i] < least:
            n = int(n * WIDEN)
        if i + n <= size:
            out.append((i, n))
    if not out or out[-1][0] + out[-1][1] < size:
        n = width
        while n < size and before[-1] - before[size - n] < least:
            n = int(n * WIDEN)
        out.append((max(0, size - n), min(n, size)))
    return out


def asked(forms: Iterator[tuple], exact: bool) -> Iterator[tuple]:
    """(number of the form, form) of those in ``FORMS``, and the exact one if asked for."""
    return zip((*FORMS, EXACT) if exact else FORMS, forms)


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, width: int, least: int, exact: bool = False) -> DataFrame:
    """item_id, form, n_tokens, n (window length), pos, h, slots: see ``widths``; in the exact form all words are literals."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                rows = []
                for item, text in zip(b.column("id").to_pylist(), utf8(b.column("text"))):
                    c = canon()
                    for form, (doc, hashes, kinds, codes, at, span) in asked(c.each_form([text]), exact):
                        hashed = c.windows(hashes, form)
                        for i, n in widths(kinds, width, least):
                            h = int(hashed.of(n, slice(i, i + 1))[0].view(np.int64))
                            rows.append((item, form, len(doc), n, i, h, c.slots(kinds, codes, at, span, i, n)))
                yield _batch(rows, ("item_id", "form", "n_tokens", "n", "pos", "h", "slots"),
                             (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())))

    return (benchmark.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(make, "item_id long, form int, n_tokens int, n int, pos int, h long, slots array<string>"))


def _batch(rows: list, names: tuple, kinds: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=list(names))


def bit_map(windows: DataFrame, bits: int) -> np.ndarray:
    """2 ** bits bits, those set of the hashes' low ends. Summed before the shuffle; at most 2 ** (bits - 6) rows come to the driver."""
    low = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
    rows = (windows.select(F.shiftrightunsigned(low, 6).alias("word"), F.expr("shiftleft(1L, CAST(h & 63 AS INT))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def doc_windows(docs: DataFrame, id_col: str, text_col: str, lengths: list[int], least: int, seen: np.ndarray, exact: bool = False) -> DataFrame:
    """doc_id, text_hash, form, n, pos, h, slots of the documents' windows that the bit map lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(seen.tobytes())
    bits = int(len(seen) * 64 - 1)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.frombuffer(shared.value, np.uint64)
        for whole in batches:
            for b in slices(whole, "text"):
                c, rows = canon(), []
                every = asked(c.each_form(b.column("text")), exact)
                ids, marks = b.column("id").to_pylist(), b.column("mark").to_pylist()
                for form, (doc, hashes, kinds, codes, at, span) in every:
                    hashed, before = c.windows(hashes, form), None
                    for n in lengths:
                        h = hashed.of(n)
                        low = h & np.uint64(bits)
                        hit = np.nonzero((have[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1))[0]
                        if not len(hit):
                            continue
                        before = literals(kinds) if before is None else before
                        for i in hit[(doc[hit] == doc[hit + n - 1]) & (before[hit + n] - before[hit] >= min(least, n))].tolist():
                            d = int(doc[i])
                            rows.append((ids[d], marks[d], form, n, i, int(h[i].view(np.int64)), c.slots(kinds, codes, at, span, i, n)))
                yield _batch(rows, ("doc_id", "text_hash", "form", "n", "pos", "h", "slots"),
                             (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string())))

    text = F.col(f"`{text_col}`").cast("string")
    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
            .mapInArrow(make, "doc_id long, text_hash long, form int, n int, pos long, h long, slots array<string>"))


def agreeing(windows: list) -> tuple[list[int], bool]:
    """Places of an alignment's windows that agree with its mapping, and whether a value is changed there.

    A benchmark value stands for the document value of most windows; of equal ones, for itself.
    """
    pairs = [{(p["a"], p["b"]) for p in w["pairs"]} for w in windows]
    best: dict[str, tuple] = {}
    for (a, b), votes in Counter(p for ps in pairs for p in ps).items():
        best[a] = max(best.get(a, (0,)), (votes, a == b, b))
    fits = [(w["at"], ps) for w, ps in zip(windows, pairs) if all(best[a][2] == b for a, b in ps)]
    return [at for at, _ in fits], any(a != b for _, ps in fits for a, b in ps)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", width: int = 8, least_literals: int = 5, min_tokens: int = 13, bits: int = 24,
               partial: bool = False, exact: bool = False) -> DataFrame:
    """doc_id, text_hash, item_id, n_windows, covered, coverage, reparameterised: a row for each document that leaks an item.

    ``covered`` counts the item's template tokens under windows that match along
    an alignment whose slots are consistent; a leak covers ``min_tokens`` of
    them, or the whole of a shorter item. An item needs ``least_literals``
    literals in a window (all its tokens, if it has fewer); windows are widened up
    to the whole item until they have them.
    ``partial``: where slots contradict each other, only the windows go that are
    against the value most windows have; without it the whole alignment goes.
    ``exact``: texts are compared word for word too, whatever literals an item
    has, so that copies of items dense in values are leaks.
    Null and empty texts match nothing; copies of a row are one document;
    rows with one id but other texts are told apart by ``text_hash``. Ids are
    integers (other types are cast, and one that is no number is an error).
    """
    items = materialize(item_windows(benchmark, item_col, item_text_col, width, least_literals, exact), "items")
    # steps of ``WIDEN`` and lengths of items without room for a step: no more than the longest item has tokens
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())
    found = doc_windows(docs, id_col, text_col, lengths, least_literals, bit_map(items, bits), exact)
    found = materialize(found.distinct(), "windows")
    # copies of a window in one item count once for each place
    met = found.join(items.withColumnRenamed("pos", "at").withColumnRenamed("slots", "values"), ["h", "n", "form"])
    # slots are "offset:text"; the same template has them at the same offsets
    met = met.where("size(values) = size(slots)")
    value = lambda x: F.regexp_replace(x, "^[0-9]+:", "")
    pairs = F.transform(F.arrays_zip("values", "slots"), lambda p: F.struct(value(p["values"]).alias("a"), value(p["slots"]).alias("b")))
    aligned = (met.withColumn("pairs", pairs)
               .groupBy("doc_id", "text_hash", "item_id", "form", "n_tokens", (F.col("pos") - F.col("at")).alias("shift"))
               .agg(F.collect_set(F.struct((F.col("at").cast("long") * F.lit(PLACE) + F.col("n")).alias("at"), "pairs")).alias("windows")))
    if partial:
        vote = F.udf(agreeing, "at array<long>, changed boolean", useArrow=True)
        kept = aligned.withColumn("kept", vote("windows")).select("*", "kept.*").drop("windows", "kept")
    else:
        values = aligned.withColumn("values", F.array_distinct(F.flatten("windows.pairs")))
        one_to_one = F.size("values") == F.size(F.array_distinct(F.transform("values", lambda p: p.a)))
        kept = values.where(one_to_one).withColumn("at", F.col("windows.at")).withColumn("changed", F.exists("values", lambda p: p.a != p.b))
    by_item = (kept.groupBy("doc_id", "text_hash", "item_id", "form", "n_tokens")
               .agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"), F.max("changed").alias("reparameterised")))
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda w: F.sequence(F.floor(w / F.lit(PLACE)), F.floor(w / F.lit(PLACE)) + w % PLACE - 1)))))
    leaks = by_item.withColumn("covered", covered).where(F.col("covered") >= F.least(F.lit(min_tokens), "n_tokens"))
    # of all forms the one that covers more
    best = F.max_by(F.struct(F.size("at").cast("long").alias("n_windows"), F.col("covered").cast("long").alias("covered"),
                             (F.col("covered") / F.col("n_tokens")).alias("coverage"), "reparameterised"),
                    F.struct(F.col("covered") / F.col("n_tokens"), "form"))
    return leaks.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("b")).select("doc_id", "text_hash", "item_id", "b.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns, repeated rows stay repeated."""
    leaks = materialize(find_leaks(docs, benchmark, id_col, text_col, **settings).select("doc_id", "text_hash").distinct(), "leaks")
    a, b = free_name(docs, "_leak_id"), free_name(docs, "_leak_text")
    leaks = leaks.withColumnsRenamed({"doc_id": a, "text_hash": b})
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(a)) & (F.xxhash64(F.col(f"`{text_col}`").cast("string")) == F.col(b))
    return docs.join(leaks, same, "left_anti")
