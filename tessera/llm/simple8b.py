"""Token ids in Simple-8b files.

A 64-bit word holds a selector in its high 4 bits and as many ids as fit, all
of the selector's width, in the other 60. Selector 15 is the escape: its 60 bits
point into the file's table of values that need more than 60 bits. Ids come in
blocks of ``BLOCK``; a block begins with a new word, and the directory has each
block's first word, so that any run of blocks can be decoded alone, all words
of a selector at once.

File: magic, words of all blocks, directory (documents, blocks, escapes),
lengths of the directory's parts. All numbers are little-endian.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow.fs as pafs

MAGIC = b"TSIMPL8B"
#: Ids a word holds, by selector (0 is not used), and their bits.
COUNT = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTH = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 15
COUNT_OF_ALL = np.append(COUNT, 1)
BLOCK = 512
#: Blocks encoded or decoded at a time.
AT_ONCE = 2048
TAIL = struct.Struct("<QQQQ")
_LIMITS = np.array([1 << int(w) for w in WIDTH[1:]], np.uint64)


def best_selectors(ids: np.ndarray) -> np.ndarray:
    """For each place of ``ids`` the selector that holds most of the ids from there on; 60 more ids must follow the last place."""
    work = ids.astype(np.uint16) if len(ids) and ids.max() < 1 << 16 else ids
    least = np.ones(len(ids), np.int8)  # the narrowest selector for each id alone
    for limit in _LIMITS[:np.searchsorted(_LIMITS, ids.max(initial=0), side="right")]:
        least += work >= work.dtype.type(limit)
    most = {1: least}  # over a window of so many ids: from two shorter windows
    for n, first in ((2, 1), (3, 2), (4, 2), (5, 4), (6, 4), (7, 4), (8, 4), (10, 8), (12, 8), (15, 8), (20, 12), (30, 15), (60, 30)):
        a, b = most[first], most[n - first]
        most[n] = np.maximum(a[:len(ids) - n + 1], b[first:first + len(ids) - n + 1])
    places = len(ids) - 60
    best = np.where(least[:places] == ESCAPE, np.int8(ESCAPE), np.int8(14))
    for s in range(13, 0, -1):
        best[most[int(COUNT[s])][:places] <= s] = s
    return best


def encode_blocks(ids: np.ndarray, escapes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks of ``ids`` (unsigned 64 bits), and each block's number of words.

    Every block is packed greedily, the word with most ids first. Zeros that
    follow the last id of a block fill its last word. Values of more than 60
    bits are appended to ``escapes``.
    """
    n, stride = len(ids), BLOCK + 60
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[:n] = ids
    wide = np.zeros((blocks, stride), np.uint64)
    wide[:, :BLOCK] = padded.reshape(blocks, BLOCK)
    flat = np.append(wide.ravel(), np.zeros(60, np.uint64))
    selector = best_selectors(flat)
    step = COUNT_OF_ALL[selector].tolist()
    starts: list[int] = []
    for b in range(blocks):
        at, end = b * stride, b * stride + min(BLOCK, n - b * BLOCK)
        while at < end:
            starts.append(at)
            at += step[at]
    place = np.array(starts, np.int64)
    chosen = selector[place].astype(np.int64)
    words = np.zeros(len(place), np.uint64)
    for s in np.unique(chosen):
        mine = place[chosen == s]
        if s == ESCAPE:
            packed = np.arange(len(escapes), len(escapes) + len(mine), dtype=np.uint64)
            escapes.extend(flat[mine].tolist())
        else:
            packed = flat[mine]
            for k in range(1, int(COUNT[s])):
                packed |= flat[mine + k] << np.uint64(k * int(WIDTH[s]))
        words[chosen == s] = packed | np.uint64(int(s) << 60)
    return words, np.bincount(place // stride, minlength=blocks)


def decode_blocks(words: np.ndarray, used: np.ndarray, sizes: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """Ids of a run of blocks: ``used`` words and ``sizes`` ids each."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNT_OF_ALL[selector]
    if (selector == 0).any():
        raise ValueError("not a Simple-8b word")
    start = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(selector):
        mine = selector == s
        body = words[mine] & np.uint64((1 << 60) - 1)
        if s == ESCAPE:
            out[start[mine]] = escapes[body.astype(np.int64)]
        else:
            shift = (np.arange(COUNT[s]) * WIDTH[s]).astype(np.uint64)
            out[start[mine][:, None] + np.arange(COUNT[s])] = (body[:, None] >> shift) & np.uint64((1 << int(WIDTH[s])) - 1)
    first = np.cumsum(used) - used  # of each block's words
    total = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
    return out[np.arange(len(out)) - np.repeat(np.cumsum(total) - total, total) < np.repeat(sizes, total)]


class Writer:
    """Writes one file. Ids are held until ``AT_ONCE`` blocks are full; the directory is kept until the end."""

    def __init__(self, folder: str):
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        # a name of its own for each attempt: what a lost or doubled task wrote is never listed
        self.path = f"{folder}/{uuid.uuid4().hex}.s8b"
        self.out = fs.open_output_stream(f"{base}/{self.path.rsplit('/', 1)[1]}")
        self.out.write(MAGIC)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.docs: list[tuple[bool, int, int]] = []
        self.used: list[np.ndarray] = []
        self.escapes: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id is not None, doc_id or 0, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= AT_ONCE * BLOCK:
            self._flush(self.n_held // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint64)
        for at in range(0, n, AT_ONCE * BLOCK):
            words, used = encode_blocks(ids[at:min(n, at + AT_ONCE * BLOCK)].astype(np.uint64), self.escapes)
            self.out.write(words.astype("<u8").tobytes())
            self.used.append(used)
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self.n_held)
        docs = np.array([(a, b, c) for a, b, c in self.docs], dtype=[("has", "<i8"), ("id", "<i8"), ("n", "<i8")])
        used = np.concatenate(self.used) if self.used else np.zeros(0, np.int64)
        first = (np.cumsum(used) - used).astype("<u8")
        parts = [docs.tobytes(), first.tobytes(), used.astype("<u4").tobytes(), np.array(self.escapes, "<u8").tobytes()]
        for p in parts:
            self.out.write(p)
        self.out.write(TAIL.pack(len(docs), len(used), len(self.escapes), self.n_ids) + MAGIC)
        self.out.close()


class Reader:
    """Reads one file: the directory first, then any blocks."""

    def __init__(self, path: str):
        fs, base = pafs.FileSystem.from_uri(path)
        self.file = fs.open_input_file(base)
        end = self.file.size() - len(MAGIC)
        tail = self.file.read_at(TAIL.size + len(MAGIC), end - TAIL.size)
        if not tail.endswith(MAGIC):
            raise ValueError(f"{path} is not a whole file of ids")
        n_docs, n_blocks, n_escapes, self.n_ids = TAIL.unpack(tail[:TAIL.size])
        sizes = [24 * n_docs, 8 * n_blocks, 4 * n_blocks, 8 * n_escapes]
        raw = self.file.read_at(sum(sizes), end - TAIL.size - sum(sizes))
        cut = np.cumsum([0, *sizes])
        self.docs = np.frombuffer(raw[:cut[1]], [("has", "<i8"), ("id", "<i8"), ("n", "<i8")])
        self.first, self.used, self.escapes = (np.frombuffer(raw[cut[i]:cut[i + 1]], t) for i, t in ((1, "<u8"), (2, "<u4"), (3, "<u8")))

    def blocks(self, start: int, n: int) -> np.ndarray:
        """Ids of ``n`` blocks from ``start``."""
        n = min(n, len(self.first) - start)
        used = self.used[start:start + n].astype(np.int64)
        words = np.frombuffer(self.file.read_at(8 * int(used.sum()), len(MAGIC) + 8 * int(self.first[start])), "<u8")
        sizes = np.full(n, BLOCK)
        if start + n == len(self.first):
            sizes[-1] = self.n_ids - (len(self.first) - 1) * BLOCK
        return decode_blocks(words, used, sizes, self.escapes)

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """doc_id, start in this file, number of ids and their crc32 (as 32-bit integers), block run by block run."""
        ids, at, start = np.zeros(0, np.uint64), 0, 0
        for has, doc, n in self.docs.tolist():
            crc, left = 0, n
            while left:
                if not len(ids):
                    ids, at = self.blocks(at, AT_ONCE), at + AT_ONCE
                crc = zlib.crc32(ids[:left].astype("<u4").tobytes(), crc)
                ids, left = ids[left:], left - min(left, len(ids))
            yield doc if has else None, start, n, crc
            start += n

