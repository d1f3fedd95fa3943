"""Words and hashes of many texts at once, in numpy over the bytes of an Arrow batch.

Spark tasks get texts in Arrow batches. A batch is cut into chunks of a few MB; all texts of a
chunk are handled by the same array operations, so no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_STEP = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finalizer known as splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(seed: int) -> int:
    return int(mix(np.array([(seed * _STEP + 1) % 2**64], np.uint64))[0]) | 1


class Chunk(NamedTuple):
    first: int
    """Row of the batch that the chunk begins with."""
    data: np.ndarray
    """The bytes of its texts, one after the other."""
    offsets: np.ndarray
    """Where each text begins; one more than texts."""

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Consecutive texts of about `limit` bytes; a longer text is a chunk of its own. Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], "string")
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset:filled.offset + len(filled) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(filled):
        last = int(np.searchsorted(at, at[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(filled))
        yield Chunk(first, raw[at[first]:at[last]], at[first:last + 1] - at[first])
        first = last


def byte_set(outside: str) -> np.ndarray:
    """Which bytes belong to words: all but the listed ASCII characters."""
    inside = np.ones(256, bool)
    inside[[ord(c) for c in outside]] = False
    return inside


#: Words are `[^\x20\x09-\x0D]+`.
SPACED = byte_set(" \t\n\x0b\x0c\r")
#: Words are runs of letters and digits, and of all beyond ASCII.
ALNUM = byte_set("".join(chr(i) for i in range(128) if not chr(i).isalnum()))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all else as it is."""
    return _LOWER[data]


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    """Number of the first word of each text; one more than texts."""

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def words(chunk: Chunk, inside: np.ndarray) -> Words:
    data, offsets = chunk.data, chunk.offsets
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(offsets), np.int64))
    member = inside[data]
    begins = offsets[:-1][np.diff(offsets) > 0]
    before = np.empty_like(member)
    before[0], before[1:] = False, member[:-1]
    before[begins] = False
    after = np.empty_like(member)
    after[-1], after[:-1] = False, member[1:]
    after[begins[1:] - 1] = False
    starts = np.flatnonzero(member & ~before)
    return Words(starts, np.flatnonzero(member & ~after) + 1, np.searchsorted(starts, offsets))


@cache
def _letters(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_odd(seed)))


@cache
def _powers(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of a number, and of its inverse, for one chunk; longer texts take them in blocks."""
    p = _odd(seed + 1000)
    n = CHUNK_BYTES + 1
    up, down = np.full(n, p, np.uint64), np.full(n, pow(p, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Hasher:
    """64-bit hashes of any byte ranges of one array, by a rolling polynomial: 8 bytes of memory a byte."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        up, self._down = _powers(seed)
        self._block = len(up) - 1
        block_up = pow(_odd(seed + 1000), self._block, 2**64)
        blocks = -(-len(data) // self._block)
        self._down_blocks = np.array(
            [pow(block_up, -k, 2**64) for k in range(blocks + 1)], np.uint64)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        letters = _letters(seed)
        for k in range(blocks):
            low, high = k * self._block, min((k + 1) * self._block, len(data))
            own = self._sums[low + 1:high + 1]
            terms = letters[data[low:high]] * up[:high - low]
            if k:
                terms *= np.uint64(pow(block_up, k, 2**64))
            np.cumsum(terms, out=own)
            own += self._sums[low]

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self._down_blocks) <= 2:
            down = self._down[starts]
        else:
            down = self._down[starts % self._block] * self._down_blocks[starts // self._block]
        return mix((self._sums[ends] - self._sums[starts]) * down)


def window_hashes(tokens: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of every `size` consecutive tokens, whether or not they are of one text."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(_odd(seed + 77)) + tokens[i:i + n]
    return mix(out)


def window_starts(offsets: np.ndarray, size: int) -> np.ndarray:
    """The tokens at which `size` tokens of one text begin."""
    n = int(offsets[-1])
    ok = np.ones(n, bool)
    lengths = np.diff(offsets)
    for back in range(1, size):
        ok[(offsets[1:] - back)[lengths >= back]] = False
    return np.flatnonzero(ok)


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of the values of each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def of_text(values: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The values told apart by the text they are in."""
    return mix(values ^ mix(text.astype(np.uint64) + np.uint64(_STEP)))
