"""Token ids of text chunks, kept by chunk, so that a chunk met again costs one look-up."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Hashable, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa


class IdPool:
    """Ids of many keys in flat arrays, in two generations.

    Past ``limit`` keys the older generation is forgotten; a key of it that is
    met in the meantime moves to the younger one. Forgetting costs time only.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.old: _Ids | None = None
        self.now = _Ids()

    def trim(self) -> None:
        """To be called between two rounds of ``gather``."""
        if len(self.now.code) > self.limit:
            self.old, self.now = self.now, _Ids()

    def add(self, keys: Sequence[Hashable], ids: np.ndarray, size: np.ndarray) -> None:
        """New keys: their ids one after the other, and how many each has."""
        self.now.add(keys, ids, size)

    def codes(self, keys: Sequence[Hashable], make: Callable[[list], None]) -> np.ndarray:
        """Where each key's ids are. ``make`` gets the distinct keys that are not known and adds them."""
        codes = np.fromiter(map(self.now.code.get, keys, repeat(-1)), np.int64, len(keys))
        absent = np.nonzero(codes < 0)[0].tolist()
        if absent:
            gone = [keys[i] for i in absent]
            new = set(gone)
            if self.old and (back := list(filter(self.old.code.__contains__, new))):
                self.now.add(back, *self.old.take(np.fromiter(map(self.old.code.__getitem__, back), np.int64, len(back))))
                new.difference_update(back)
            if new:
                make(list(new))
            codes[absent] = np.fromiter(map(self.now.code.__getitem__, gone), np.int64, len(gone))
        return codes

    def gather(self, keys: Sequence[Hashable], make: Callable[[list], None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all keys one after the other, and how many each has."""
        return self.now.take(self.codes(keys, make))

    def gather_array(self, keys: pa.Array, make: Callable[[list], None]) -> tuple[np.ndarray, np.ndarray]:
        """As ``gather``, for an Arrow array of keys: only distinct ones become Python objects."""
        found = keys.dictionary_encode()
        codes = self.codes(found.dictionary.to_pylist(), make)
        return self.now.take(codes[found.indices.to_numpy()])


def by_group(size: np.ndarray, n: Sequence[int] | np.ndarray) -> np.ndarray:
    """Sums of ``size`` over groups of ``n`` neighbours each (a group may be empty)."""
    bounds = np.concatenate([[0], np.cumsum(np.asarray(n, np.int64))]).astype(np.int64)
    return np.diff(np.concatenate([[0], np.cumsum(size)])[bounds]).astype(np.int64)


class _Ids:
    def __init__(self) -> None:
        self.code: dict[Hashable, int] = {}
        self.start, self.size, self.flat = array("q"), array("i"), array("i")

    def add(self, keys: Sequence[Hashable], ids: np.ndarray, size: np.ndarray) -> None:
        size = np.asarray(size, np.int64)
        self.code.update(zip(keys, range(len(self.start), len(self.start) + len(keys))))
        self.start.frombytes((np.cumsum(size) - size + len(self.flat)).astype(np.int64).tobytes())
        self.size.frombytes(size.astype(np.int32).tobytes())
        self.flat.frombytes(np.asarray(ids, np.int32).tobytes())

    def take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        start = np.frombuffer(self.start, np.int64)[codes]
        size = np.frombuffer(self.size, np.int32)[codes].astype(np.int64)
        ends = np.cumsum(size)
        where = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
        flat = np.frombuffer(self.flat, np.int32) if len(self.flat) else np.zeros(0, np.int32)
        return flat[where], size
