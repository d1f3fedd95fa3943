"""What a task has encoded so far: the ids of each distinct stretch of bytes, by its hash."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class Memory:
    """Ids by 64-bit key, found by array operations, of at most `limit` keys or one chunk's.

    Each key has a slot in two tables; a key that finds both taken displaces one, which is then
    encoded again when it comes back. When full, all is forgotten, so memory is bounded.
    """

    def __init__(self, dtype: np.dtype | str, bits: int = 20, limit: int = 1_000_000):
        self._dtype, self._mask, self._limit = np.dtype(dtype), np.uint64((1 << bits) - 1), limit
        self._forget()

    def __reduce__(self):
        return Memory, (self._dtype, int(self._mask).bit_length(), self._limit)

    def _forget(self) -> None:
        size = int(self._mask) + 1
        self._slots = np.zeros(size, np.int32), np.zeros(size, np.int32)
        self._keys = np.zeros(1, np.uint64)  # entry 0 stands for an empty slot
        self._starts, self._lengths = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self._pool = np.zeros(0, self._dtype)

    def entries(self, keys: np.ndarray,
                encode: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The entry of each key. `encode` gets places of new keys; returns their ids and lengths."""
        entry = self._slots[0][keys & self._mask]
        rest = np.flatnonzero(self._keys[entry] != keys)
        other = self._slots[1][(keys[rest] >> np.uint64(32)) & self._mask]
        entry[rest] = other
        rest = rest[self._keys[other] != keys[rest]]
        if not len(rest):
            return entry
        new, first, which = np.unique(keys[rest], return_index=True, return_inverse=True)
        known = len(self._keys)
        if known > 1 and known + len(new) > self._limit:
            self._forget()
            return self.entries(keys, encode)
        ids, lengths = encode(rest[first])
        entry[rest] = known + which
        numbers = np.arange(known, known + len(new), dtype=np.int32)
        self._keys = np.concatenate([self._keys, new])
        self._starts = np.concatenate([self._starts, len(self._pool) + np.cumsum(lengths) - lengths])
        self._lengths = np.concatenate([self._lengths, lengths])
        self._pool = np.concatenate([self._pool, ids.astype(self._dtype)])
        slot = new & self._mask
        free = self._slots[0][slot] == 0
        self._slots[0][slot[free]] = numbers[free]
        left = self._slots[0][slot] != numbers
        self._slots[1][(new[left] >> np.uint64(32)) & self._mask] = numbers[left]
        return entry

    def lengths(self, entry: np.ndarray) -> np.ndarray:
        return self._lengths[entry]

    def ids(self, entry: np.ndarray) -> np.ndarray:
        """The ids of all entries, one after the other."""
        lengths = self._lengths[entry]
        last = np.cumsum(lengths)
        total = int(last[-1]) if len(last) else 0
        return self._pool[np.repeat(self._starts[entry] - last + lengths, lengths) + np.arange(total)]
