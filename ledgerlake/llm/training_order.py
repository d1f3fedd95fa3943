"""Training-order materialisation: token ids of all texts as shards of fixed stride.

Every text is encoded by a public tokenizer, ended by an end id, and cut into sequences of `length`
ids; the last one is padded. Sequences are numbered in the order of the input's partitions and rows.
A keyed Feistel permutation of the numbers, walked along its cycle until it falls below their count,
gives each sequence its slot in the training order. Slots are dealt out in ranges, one per shard
file, and each task writes its range in order: slot s is at byte (s % shard_slots) * stride of shard
s // shard_slots. A reader can start at any slot and reads on sequentially.

Texts are encoded twice, once to count the sequences of each partition and once to write them. That
costs less disk than keeping the ids. The input must give the same rows in the same partitions both
times, as a stored table does; where it does not, the counts disagree and the job fails. A task that
is run again writes the same bytes under the same name, by a file of its own that is then renamed.

A null or empty text has no sequence. Rows that repeat have sequences of their own. No documents: no
shards. Very long texts are encoded whole, a chunk of their own, with about 40 bytes of memory for each
of their bytes in that task. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import text as T
from ledgerlake.llm.memory import Memory
from ledgerlake.sources.workspace import fresh_path, written

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how this family of tokenizers cuts a text into pieces.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Bytes that may begin white space: ASCII's, and the lead bytes of all beyond it.
_MAY_BE_SPACE = np.zeros(256, bool)
_MAY_BE_SPACE[[9, 10, 11, 12, 13, 32, 0xC2, 0xE1, 0xE2, 0xE3]] = True


class Encoder:
    """Byte-level BPE over the ranks of a tokenizer file; the id after the last ends a text.

    A space before anything but white space always begins a piece, so a text can be cut there into
    stretches, mostly words, that are encoded by themselves. A task encodes each distinct stretch
    once and looks the others up by hash, all stretches of a chunk at a time.
    """

    def __init__(self, ranks: bytes):
        self._ranks = ranks

    def __reduce__(self):
        return Encoder, (self._ranks,)

    @cached_property
    def _memory(self) -> Memory:
        return Memory(self.dtype)

    @cached_property
    def _bpe(self):
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self._ranks.splitlines())}
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def _bytes(self) -> np.ndarray:
        """How many bytes each id stands for."""
        return np.array([len(base64.b64decode(x.split()[0])) for x in self._ranks.splitlines()])

    @cached_property
    def end(self) -> int:
        return len(self._ranks.splitlines())

    @cached_property
    def dtype(self) -> np.dtype:
        return np.dtype("<u2" if self.end < 2**16 else "<u4")

    def _entries(self, chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The entry of every stretch, and the number of stretches before each text."""
        data, offsets = chunk.data, chunk.offsets
        full = np.diff(offsets) > 0
        begins = np.zeros(len(data), bool)
        begins[:-1] = (data[:-1] == 32) & ~_MAY_BE_SPACE[data[1:]]
        begins[offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))] - 1] &= False
        begins[offsets[:-1][full]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        raw = data.tobytes()
        entry = self._memory.entries(
            T.Hasher(data, 5)(starts, ends),
            lambda at: self._fresh([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]))
        return entry, np.searchsorted(starts, offsets)

    def lengths(self, chunk: T.Chunk) -> np.ndarray:
        """How many ids each text has, the end id included."""
        entry, stretches = self._entries(chunk)
        sums = np.append(0, np.cumsum(self._memory.lengths(entry)))[stretches]
        return np.diff(sums) + (np.diff(chunk.offsets) > 0)

    def encode(self, chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id behind, and where each text's begin.

        An empty text has none.
        """
        entry, stretches = self._entries(chunk)
        full = np.diff(chunk.offsets) > 0
        sums = np.append(0, np.cumsum(self._memory.lengths(entry)))[stretches]
        ids = np.insert(self._memory.ids(entry), sums[1:][full], self.end)
        return ids, sums + np.append(0, np.cumsum(full))

    def _fresh(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of new stretches, one after the other, and how many each has."""
        # those that begin with their space can be encoded as one text and told apart afterwards
        joins = np.array([len(t) > 1 and t[0] == 32 and not _MAY_BE_SPACE[t[1]] for t in texts], bool)
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        ids, lengths = self._joined([texts[i] for i in np.flatnonzero(joins)])
        alone = [self._bpe.encode_ordinary(texts[i].decode()) for i in np.flatnonzero(~joins)]
        pool = np.concatenate([ids, *(np.array(x, self.dtype) for x in alone)]).astype(self.dtype)
        lengths = np.concatenate([lengths, [len(x) for x in alone]]).astype(np.int64)
        back = np.argsort(order)
        starts, lengths = (np.cumsum(lengths) - lengths)[back], lengths[back]
        last = np.cumsum(lengths)
        return pool[np.repeat(starts - last + lengths, lengths) + np.arange(lengths.sum())], lengths

    def _joined(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts, and how many each has."""
        ids, lengths = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for at in range(0, len(parts), 20_000):
            some = parts[at:at + 20_000]
            own = np.array(self._bpe.encode_ordinary(b"".join(some).decode()))
            stops = np.searchsorted(np.cumsum(self._bytes[own]), np.cumsum([len(p) for p in some])) + 1
            ids.append(own.astype(self.dtype))
            lengths.append(np.diff(stops, prepend=0))
        return np.concatenate(ids), np.concatenate(lengths)


@dataclass(frozen=True)
class Layout:
    sequences: int
    length: int
    shard_slots: int
    width: int
    key: int

    @property
    def stride(self) -> int:
        return self.length * self.width

    @property
    def shards(self) -> int:
        return -(-self.sequences // self.shard_slots)


def _feistel(x: np.ndarray, half: int, key: int) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for turn in range(6):
        keyed = T.mix(np.array([(key * 6 + turn + 1) % 2**64], np.uint64))[0]
        left, right = right, left ^ (T.mix(right ^ keyed) & mask)
    return (left << np.uint64(half)) | right


def slots(numbers: np.ndarray, count: int, key: int) -> np.ndarray:
    """Where the keyed permutation of 0 .. count - 1 puts each number."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    x = _feistel(numbers.astype(np.uint64), half, key)
    out = np.flatnonzero(x >= count)
    while len(out):
        x[out] = _feistel(x[out], half, key)
        out = out[x[out] >= count]
    return x.astype(np.int64)


def _counts(encoder, length: int):
    """(part, n): how many sequences each task's rows give."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for chunk in T.chunks(batch.column(1)):
                n += int((-(-encoder.value.lengths(chunk) // length)).sum())
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                          "n": pa.array([n], pa.int64())})
    return run


_SEQUENCE = ("slot long, shard int, doc_id long, position int, n_tokens int, tokens binary")


def _sequences(encoder, starts, layout: Layout):
    """Every sequence with its slot; not padded yet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number, last = starts.value[part]
        for batch in batches:
            for chunk in T.chunks(batch.column(1)):
                tokens, offsets = encoder.value.encode(chunk)
                parts = -(-np.diff(offsets) // layout.length)
                text = np.repeat(np.arange(chunk.texts), parts)
                position = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
                first = offsets[text] + position * layout.length
                n_tokens = np.minimum(first + layout.length, offsets[text + 1]) - first
                slot = slots(np.arange(number, number + len(text)), layout.sequences, layout.key)
                number += len(text)
                if number > last:
                    raise ValueError("the input changed between counting and writing")
                bounds = np.append(first, offsets[-1]) * layout.width
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array((slot // layout.shard_slots).astype(np.int32)),
                     batch.column(0).slice(chunk.first, chunk.texts).take(pa.array(text)),
                     pa.array(position.astype(np.int32)), pa.array(n_tokens.astype(np.int32)),
                     pa.Array.from_buffers(pa.binary(), len(text), [
                         None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(tokens.tobytes())])],
                    [c.split()[0] for c in _SEQUENCE.split(", ")])
        if number != last:
            raise ValueError("the input changed between counting and writing")
    return run


_PLACED = ("slot long, shard string, offset long, doc_id long, position int, n_tokens int, crc32 long")


def _writer(folder: str, layout: Layout, pad: bytes):
    """Writes the sequences, sorted by slot, to their shards and says where each one is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pyarrow.fs.FileSystem.from_uri(folder)
        shard, out, temporary, due = None, None, "", 0

        def close():
            if out is not None:
                out.close()
                if due != min((shard + 1) * layout.shard_slots, layout.sequences):
                    raise ValueError(f"shard {shard} is not whole")
                fs.move(temporary, f"{path}/{_shard_name(shard)}")

        for batch in batches:
            slot, of, n = (batch.column(i).to_numpy() for i in (0, 1, 4))
            if not len(slot):
                continue
            tokens = batch.column(5)
            places = np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset:tokens.offset + len(slot) + 1]
            raw = memoryview(tokens.buffers()[2])
            padded = np.tile(np.frombuffer(pad, np.uint8), (len(slot), 1))
            padded[np.arange(layout.stride) < (n * layout.width)[:, None]] = np.frombuffer(
                raw, np.uint8)[places[0]:places[-1]]
            # one write for each run of slots that goes to the same shard
            edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for a, b in zip(edges, edges[1:]):
                if of[a] != shard:
                    close()
                    shard, due = int(of[a]), int(of[a]) * layout.shard_slots
                    temporary = f"{path}/_{_shard_name(shard)}.{uuid.uuid4().hex}"
                    out = fs.open_output_stream(temporary, compression=None)
                if (slot[a:b] != np.arange(due, due + b - a)).any():
                    raise ValueError(f"a slot from {due} on is missing or taken twice")
                due += b - a
                out.write(padded[a:b].tobytes())
            names = pa.array([_shard_name(s) for s in of[edges[:-1]].tolist()])
            run_of = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
            at = places.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), names.take(pa.array(run_of)),
                 pa.array((slot - of.astype(np.int64) * layout.shard_slots) * layout.stride),
                 *(batch.column(i) for i in (2, 3, 4)),
                 pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])], pa.int64())],
                [c.split()[0] for c in _PLACED.split(", ")])
        close()
    return run


def _shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def write_shards(docs: DataFrame, folder: str | None = None, doc_id: str = "doc_id", text: str = "text",
                 tokenizer: str = TOKENIZER, length: int = 256, shard_slots: int = 32_768,
                 key: int = 1) -> DataFrame:
    """Write all texts as shards to `folder` and return where each sequence is.

    Columns: `slot`, `shard`, `offset` (bytes), `doc_id`, `position` (of the sequence in its text),
    `n_tokens` (without padding) and `crc32` of their bytes.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "training-order")
    with open(tokenizer, "rb") as f:  # a few MB, as large for any corpus
        encoder = Encoder(f.read())
    shared = spark.sparkContext.broadcast(encoder)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = dict(tuple(r) for r in rows.mapInArrow(_counts(shared, length), "part int, n long").collect())
    starts, total = {}, 0
    for part in sorted(counts):  # one number for each task
        starts[part] = (total, total + counts[part])
        total += counts[part]
    layout = Layout(total, length, shard_slots, encoder.dtype.itemsize, key)
    fs, path = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/layout.json", compression=None) as f:
        f.write(json.dumps(asdict(layout) | {"dtype": str(encoder.dtype), "end": encoder.end}).encode())
    placed = rows.mapInArrow(_sequences(shared, spark.sparkContext.broadcast(starts), layout), _SEQUENCE)
    pad = np.full(length, encoder.end, encoder.dtype).tobytes()
    by_shard = placed.repartitionById(max(1, layout.shards), "shard").sortWithinPartitions("slot")
    return written(by_shard.mapInArrow(_writer(folder, layout, pad), _PLACED), "sequences")


def read_slots(folder: str, first: int = 0, last: int | None = None, batch: int = 1024) -> Iterator[np.ndarray]:
    """The sequences of the slots first .. last - 1 in order, `batch` rows of ids at a time."""
    fs, path = pyarrow.fs.FileSystem.from_uri(folder)
    with fs.open_input_stream(f"{path}/layout.json", compression=None) as f:
        said = json.loads(f.read())
    layout = Layout(**{k: said[k] for k in Layout.__dataclass_fields__})
    slot, last = first, layout.sequences if last is None else min(last, layout.sequences)
    while slot < last:
        shard = slot // layout.shard_slots
        until = min(last, (shard + 1) * layout.shard_slots)
        with fs.open_input_file(f"{path}/{_shard_name(shard)}") as f:
            f.seek((slot - shard * layout.shard_slots) * layout.stride)
            while slot < until:
                n = min(batch, until - slot)
                yield np.frombuffer(f.read(n * layout.stride), said["dtype"]).reshape(n, layout.length)
                slot += n
