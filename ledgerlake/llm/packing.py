"""Packing of tokenised documents into sequences of one size, shortest pack first.

Every text is encoded by a public tokenizer and ended by an end id. Each document gives as many full
pieces of `size` ids as it has and one remainder; the remainders' lengths are counted. Packs are then
planned over that length histogram alone, in the driver, whose size only `size` bounds: lengths are
placed longest first, each into the shortest pack that still takes it, as whole groups of packs that
hold the same lengths (a pattern and a count). A pattern's packs take runs of ranks among the pieces
of a length, so that a piece finds its sequence and offset from its length and rank.

Remainders stay whole where that packs well. Where more than `padding` of the sequences would be
padding, as when very many documents have one length, they are cut at falling powers of two, down to
the largest `least` that meets it; the rest of fewer than `least` ids is a piece by itself.

Ranks are counted per task and then offset by the counts of the tasks before; nothing is collected
by length, so a length that a third of all pieces have is spread as they are.

A null or empty text is the end id alone. Rows that repeat are documents of their own; a null id
stays null. No documents: no pieces. Very long texts are encoded whole, a chunk of their own, with
about 40 bytes of memory for each of their bytes in that task; their ids are one row. Only the named
columns are read, so others cannot clash.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import text as T
from ledgerlake.llm.memory import Memory
from ledgerlake.llm.sizes import small_side
from ledgerlake.sources.workspace import written

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
SIZE = 2048
END = 1
PADDING = 0.01


class Encoder:
    """A tokenizer that drops white space, so that texts are encoded word by word.

    A task encodes each distinct word once and looks the others up by hash.
    """

    def __init__(self, said: str):
        self._said = said

    def __reduce__(self):
        return Encoder, (self._said,)

    @cached_property
    def _tokenizer(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        return Tokenizer.from_str(self._said)

    @cached_property
    def _memory(self) -> Memory:
        return Memory("<u4")

    def encode(self, chunk: T.Chunk, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with `end` behind, and where each text's begin."""
        found = T.words(chunk, T.SPACED)
        starts, ends = found.starts, found.ends
        raw = chunk.data.tobytes()

        def fresh(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            words = [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            ids = [x.ids for x in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            return np.array([i for x in ids for i in x], "<u4"), np.array([len(x) for x in ids], np.int64)

        if not len(starts):
            return np.full(chunk.texts, end, "<u4"), np.arange(chunk.texts + 1)
        entry = self._memory.entries(T.Hasher(chunk.data, 9)(starts, ends), fresh)
        sums = np.append(0, np.cumsum(self._memory.lengths(entry)))[found.offsets]
        ids = np.insert(self._memory.ids(entry), sums[1:], end).astype("<u4")
        return ids, sums + np.arange(chunk.texts + 1)


def _tokens(encoder, end: int):
    """(doc_id, ids): the ids of each document, two bytes each where all fit, else four."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in T.chunks(batch.column(1)):
                ids, offsets = encoder.value.encode(chunk, end)
                width = 2 if int(ids.max(initial=0)) < 2**16 else 4
                raw = ids.astype(f"<u{width}").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.texts), pa.array(np.diff(offsets)),
                     pa.Array.from_buffers(pa.large_binary(), chunk.texts, [
                         None, pa.py_buffer((offsets * width).astype(np.int64).tobytes()),
                         pa.py_buffer(raw)]).cast(pa.binary())],
                    ["doc_id", "doc_tokens", "ids"])
    return run


def cuts(remainder: int, least: int) -> list[int]:
    """A remainder's pieces: whole if `least` is 0, else falling powers of two and what is left."""
    if not least or remainder < least:
        return [remainder] if remainder else []
    tail = remainder % least
    heads = [1 << b for b in reversed(range(remainder.bit_length())) if (remainder - tail) >> b & 1]
    return heads + ([tail] if tail else [])


class Pack(NamedTuple):
    count: int
    """How many packs have this pattern."""
    pattern: tuple[tuple[int, int], ...]
    """(length, how many pieces of it), in order of placing."""
    space: int


def plan(histogram: dict[int, int], size: int) -> list[Pack]:
    """Packs for so many pieces of each length: longest first, each into the shortest that takes it."""
    by_space: dict[int, list[Pack]] = {}
    spaces: list[int] = []

    def put(pack: Pack) -> None:
        if not pack.count:
            return
        if not by_space.get(pack.space):
            by_space[pack.space] = []
            heapq.heappush(spaces, -pack.space)
        by_space[pack.space].append(pack)

    def with_one_more(pack: Pack, count: int, length: int) -> Pack:
        *before, (last, times) = pack.pattern
        more = (*before, (last, times + 1)) if last == length else (*pack.pattern, (length, 1))
        return Pack(count, more, pack.space - length)

    for length, n in sorted(histogram.items(), reverse=True):
        while n:
            while spaces and not by_space[-spaces[0]]:
                heapq.heappop(spaces)
            if spaces and -spaces[0] >= length:
                pack = by_space[-spaces[0]].pop()
                taken = min(n, pack.count)
                put(pack._replace(count=pack.count - taken))
                put(with_one_more(pack, taken, length))
                n -= taken
            else:
                each = size // length
                put(Pack(n // each, ((length, each),), size - each * length))
                if n % each:
                    put(Pack(1, ((length, n % each),), size - n % each * length))
                n = 0
    return [pack for space in sorted(by_space) for pack in by_space[space]]


def padded(packs: list[Pack], size: int) -> int:
    """Padding of all packs; one filled to a power of two is not padded."""
    return sum(p.count * p.space for p in packs if (size - p.space) & (size - p.space - 1))


def least_cut(histogram: dict[int, int], size: int, padding: float) -> int:
    """The largest power of two at which remainders must be cut to pad so little; 0 for none."""
    best: tuple[float, int] | None = None
    for least in [0, *(1 << b for b in reversed(range(4, size.bit_length() - 1)))]:
        pieces: dict[int, int] = {}
        for remainder, n in histogram.items():
            for piece in cuts(remainder, least):
                pieces[piece] = pieces.get(piece, 0) + n
        lost = padded(plan(pieces, size), size)
        share = lost / max(1, lost + sum(k * n for k, n in histogram.items()))
        if share <= padding:
            return least
        if best is None or share < best[0]:
            best = (share, least)
    return best[1] if best else 0


_PIECES = ("doc_id long, start long, length int, doc_tokens long, ids binary, part int, rank long")


def _pieces(size: int, least: int):
    """Cuts documents and ranks each piece among those of its length in this task."""
    remainders = [cuts(r, least) for r in range(size)]
    n_cuts = np.array([len(x) for x in remainders])
    first_cut = np.cumsum(n_cuts) - n_cuts
    flat = np.array([c for x in remainders for c in x], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            tokens = batch.column(1).to_numpy().astype(np.int64)
            full, rest = tokens // size, tokens % size
            number = full + n_cuts[rest]
            doc = np.repeat(np.arange(len(tokens)), number)
            k = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
            cut = first_cut[rest[doc]] + k - full[doc]
            length = np.where(k < full[doc], size, flat[np.clip(cut, 0, max(len(flat) - 1, 0))]
                              if len(flat) else size)
            ends = np.cumsum(length)
            start = ends - length - np.repeat(ends[np.cumsum(number) - 1] - tokens, number)
            order = np.argsort(length, kind="stable")
            fresh = np.bincount(length, minlength=size + 1)
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.arange(len(doc)) - np.repeat(np.cumsum(fresh) - fresh - seen, fresh)
            seen += fresh
            raw = [x.as_buffer() for x in batch.column(2)]
            ids = []
            for d, a, n in zip(doc.tolist(), start.tolist(), length.tolist()):
                width = len(raw[d]) // int(tokens[d])
                own = np.frombuffer(raw[d], f"<u{width}", n, a * width)
                ids.append(own.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(start), pa.array(length.astype(np.int32)),
                 pa.array(tokens[doc]), pa.array(ids, pa.binary()),
                 pa.array(np.full(len(doc), part, np.int32)), pa.array(rank)],
                [c.split()[0] for c in _PIECES.split(", ")])
    return run


class Runs:
    """Which runs of ranks among the pieces of a length go where."""

    def __init__(self, packs: list[Pack], size: int):
        rows, taken, sequence = [], {}, 0
        for pack in packs:
            offset = 0
            for length, times in pack.pattern:
                first = taken.get(length, 0)
                taken[length] = first + pack.count * times
                rows.append((length << 48 | first, pack.count, sequence, offset, length))
                offset += length * times
            sequence += pack.count
        self.first, self.count, self.sequence, self.offset, self.length = (
            np.array(c, np.int64) for c in (zip(*sorted(rows)) if rows else [[]] * 5))

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequence and offset of each piece."""
        key = length << 48 | rank
        at = np.searchsorted(self.first, key, "right") - 1
        within = key - self.first[at]
        return (self.sequence[at] + within % self.count[at],
                self.offset[at] + within // self.count[at] * length)


def _places(runs, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            by_name = dict(zip(batch.schema.names, batch.columns))
            length = by_name["length"].to_numpy().astype(np.int64)
            sequence, offset = runs.value.find(length, by_name["rank"].to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(by_name[c] for c in columns), pa.array(sequence), pa.array(offset)],
                [*columns, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
         size: int = SIZE, end: int = END, padding: float = PADDING, ids: bool = True) -> DataFrame:
    """Per piece: where it is from and where it goes.

    Columns: `doc_id`, `start` (ids of its document before it), `length`, `doc_tokens` (of its document,
    the end id included), `ids_crc32` of its ids as little-endian 32-bit numbers, `ids` themselves in
    that form if wanted, `sequence_id` and `offset` in the sequence.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:  # a few MB, as large for any corpus
        encoder = spark.sparkContext.broadcast(Encoder(f.read()))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tokens = written(rows.mapInArrow(_tokens(encoder, end), "doc_id long, doc_tokens long, ids binary"),
                     "tokens")
    remainders = {r[0]: r[1] for r in tokens.groupBy(
        (F.col("doc_tokens") % size).cast("int").alias("r")).count().collect() if r[0]}
    least = least_cut(remainders, size, padding)
    wanted = [c.split()[0] for c in _PIECES.split(", ")]
    pieces = tokens.mapInArrow(_pieces(size, least), _PIECES).select(
        *(c for c in wanted if ids or c != "ids"), F.crc32("ids").alias("ids_crc32"))
    pieces = written(pieces, "pieces")
    counted = written(pieces.groupBy("part", "length").agg((F.max("rank") + 1).alias("n")), "lengths")
    histogram = {r[0]: r[1] for r in counted.groupBy("length").agg(F.sum("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(small_side(base), ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    shown = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", *(["ids"] if ids else [])]
    schema = ("doc_id long, start long, length int, doc_tokens long, ids_crc32 long,"
              + (" ids binary," if ids else "") + " sequence_id long, offset long")
    runs = spark.sparkContext.broadcast(Runs(plan(histogram, size), size))
    return ranked.select(*shown, "rank").mapInArrow(_places(runs, shown), schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """`sequence_id`, `ids` (little-endian 32-bit, not padded) and the documents' spans, from `pack`."""
    own = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids")))
    return pieces.groupBy("sequence_id").agg(own.alias("own")).select(
        "sequence_id", F.expr("aggregate(own.ids, x'', (a, x) -> concat(a, x))").alias("ids"),
        F.transform("own", lambda x: F.struct(x["offset"], x["length"], x["doc_id"], x["start"])).alias("spans"))


def report(docs: DataFrame, **options) -> DataFrame:
    """The pieces without their ids, lengths and offsets as 64-bit numbers."""
    return pack(docs, ids=False, **options).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        "sequence_id", "offset")
