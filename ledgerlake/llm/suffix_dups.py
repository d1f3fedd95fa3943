"""Repeated passages: every byte in a run of `length` bytes that also starts earlier.

Ranks by prefix doubling settle which positions of a corpus start with equal strings: positions with
equal names for h bytes are told apart by pairs of names at growing offsets, and positions whose
name is unique drop out. Sorting a row for each byte costs tens of times the input in shuffle, so
here only sampled positions get rows:

1. In each task, every window of `length` bytes picks the 24-byte string in it with the smallest
   hash (its anchor). Equal windows pick the same anchor, so a window can only repeat if its anchor's
   24-byte name does. Windows in a row with one anchor are one row: anchor name, place, and the name
   of all bytes that these windows cover.
2. Spark counts the 24-byte names; unique ones drop out with all their windows.
3. What is left is ranked by the pair (24-byte name, name of the whole covered run): of equal pairs
   the first in order is the source, and all windows of the others are repeats.
4. Where one 24-byte name still has several longer names, the windows of their first places are
   ranked one by one, by the pair (24-byte name, name of the window's `length` bytes). Their bytes are
   sorted by 24-byte name and ranked in a task, a bounded number of places per name; names with more
   places are ranked by a Spark aggregation over rows of windows.

Order is by doc_id, then by place. Names are 48- and 64-bit hashes; a repeat is two equal ones.
Frequent names are counted on the map side and joined back, which Spark splits; no task holds all
places of a name.

Null text is empty. A null id comes last. Rows that repeat a doc_id are ordered by a hash of their
text; those that repeat the text too are one document, and each returns its result. No documents: no
rows. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import text as T
from ledgerlake.llm.sizes import small_side
from ledgerlake.sources.workspace import written

ANCHOR = 24
#: Places of one name that a task ranks at most.
PLACES = 4096
PIECE = 4 << 20
#: Windows that a task expands at once, those of one name always together.
WINDOWS = 1 << 18
_LAST = 2**63 - 1
_PLACE = np.uint64(2**24 - 1)
_PLACED = "id long, tie int, first long, last long, name long, run long"


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` neighbours, by minima from the borders of blocks."""
    n = len(x)
    blocks = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    blocks[:n] = x
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchored_runs(data: np.ndarray, offsets: np.ndarray, length: int):
    """(text, first window, last window, anchor name, run name) of windows in a row with one anchor."""
    none = np.zeros(0, np.int64)
    lengths = np.diff(offsets)
    change = np.zeros(len(data) + 1, np.int64)
    full = lengths >= length
    np.add.at(change, offsets[:-1][full], 1)
    np.add.at(change, offsets[1:][full] - length + 1, -1)
    windows = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    if not len(windows):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    at = np.arange(len(data) - ANCHOR + 1)
    names = T.Hasher(data, 1)(at, at + ANCHOR)
    smallest = _sliding_min((names & ~_PLACE) | at.astype(np.uint64), length - ANCHOR + 1)
    anchor = (smallest[windows] & _PLACE).astype(np.int64)
    new = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    begins = np.flatnonzero(np.concatenate([[True], new]))
    first = windows[begins]
    last = windows[np.append(begins[1:], len(windows)) - 1]
    runs = T.Hasher(data, 2)(first, last + length)
    text = np.searchsorted(offsets, first, "right") - 1
    return text, first - offsets[text], last - offsets[text], names[anchor[begins]], runs


def _runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for chunk in T.chunks(batch.column(2), min(T.CHUNK_BYTES // 2, PIECE)):
                # a very long text goes piece by piece; pieces overlap by a window
                for start in range(0, max(len(chunk.data), 1), PIECE):
                    data, offsets = chunk.data[start:start + PIECE + length - 1], chunk.offsets
                    if chunk.texts == 1:
                        offsets = np.array([0, len(data)])
                    text, first, last, names, runs = anchored_runs(data, offsets, length)
                    row = chunk.first + text
                    yield pa.RecordBatch.from_pydict({
                        "id": ids[row], "tie": ties[row], "first": first + start,
                        "last": last + start, "name": (names >> np.uint64(16)).view(np.int64),
                        "run": runs.view(np.int64)})
    return run


def _list_parts(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets and the flat fields of a list of structs."""
    return (column.offsets.to_numpy(),
            [column.values.field(i).to_numpy() for i in range(column.type.value_type.num_fields)])


_CONTEXT = "id long, tie int, first long, last long, name long, bytes binary"


def _contexts(length: int):
    """(id, tie, first, last, name, bytes) of the open runs of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            bounds, (first, last, name) = _list_parts(batch.column(3))
            for chunk in T.chunks(batch.column(2)):
                raw = chunk.data.tobytes()
                own = bounds[chunk.first:chunk.first + chunk.texts + 1]
                part = slice(own[0], own[-1])
                text = np.repeat(np.arange(chunk.texts), np.diff(own))
                row, begins = chunk.first + text, chunk.offsets[text]
                cut = [raw[a:b + length] for a, b in zip(
                    (begins + first[part]).tolist(), (begins + last[part]).tolist())]
                yield pa.RecordBatch.from_pydict({
                    "id": ids[row], "tie": ties[row], "first": first[part], "last": last[part],
                    "name": name[part], "bytes": pa.array(cut, pa.binary())})
    return run


def _each_window(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number in its row, name) of every window of rows of contexts."""
    raw = table.column("bytes").to_pylist()
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    width = np.diff(offsets) - length + 1
    row = np.repeat(np.arange(len(raw)), width)
    number = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width)
    begins = offsets[row] + number
    return row, number, T.Hasher(data, 3)(begins, begins + length)


def _windows(length: int):
    """(id, tie, first, name, run): the windows of the open runs, each by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                table = pa.Table.from_batches([batch.slice(at, 1_000)])
                row, number, names = _each_window(table, length)
                of = {c: table.column(c).to_numpy()[row] for c in ("id", "tie", "first", "name")}
                yield pa.RecordBatch.from_pydict(
                    {**of, "first": of["first"] + number, "run": names.view(np.int64)})
    return run


def _ranked(length: int):
    """(id, tie, first, last): repeated bytes among contexts sorted by name, then by place."""
    def repeats(table: pa.Table) -> pa.RecordBatch:
        row, number, names = _each_window(table, length)
        of = {c: table.column(c).to_numpy() for c in ("id", "tie", "first", "name")}
        keys = T.mix(names ^ T.mix(of["name"].view(np.uint64))[row])
        _, firsts = np.unique(keys, return_index=True)  # rows are in order, so the first has the place
        again = np.ones(len(row), bool)
        again[firsts] = False
        goes_on = again[1:] & again[:-1] & (row[1:] == row[:-1])
        begin = np.flatnonzero(again & ~np.concatenate([[False], goes_on])[:len(again)])
        end = np.flatnonzero(again & ~np.concatenate([goes_on, [False]])[:len(again)])
        at = row[begin]
        return pa.RecordBatch.from_pydict({
            "id": of["id"][at], "tie": of["tie"][at], "first": of["first"][at] + number[begin],
            "last": of["first"][at] + number[end] + length})

    def blocks(table: pa.Table) -> Iterator[pa.Table]:
        """Rows of whole names, of a bounded number of windows or one name's."""
        names = table.column("name").to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1], [True]]))
        sizes = pc.binary_length(table.column("bytes")).to_numpy() - (length - 1)
        before = np.concatenate([[0], np.cumsum(sizes)])[begins]
        at = 0
        while at < len(begins) - 1:
            end = max(at + 1, int(np.searchsorted(before, before[at] + WINDOWS, "right")) - 1)
            yield table.slice(begins[at], begins[end] - begins[at])
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            names = held.column("name").to_numpy()
            if not len(names):
                continue
            whole = int(np.searchsorted(names, names[-1]))  # the last name may go on in the next batch
            if whole:
                yield from map(repeats, blocks(held.slice(0, whole)))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield from map(repeats, blocks(held))
    return run


def removed(text: bytes, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, int]:
    """Which bytes the spans cover, and in how many runs."""
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last, -1)
    hit = np.cumsum(change[:-1]) > 0
    return hit, int(hit[:1].sum() + (hit[1:] & ~hit[:-1]).sum())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n_bytes, n_removed, n_spans, kept): the texts without the spans."""
    for batch in batches:
        bounds, (first, last) = _list_parts(batch.column(2))
        for chunk in T.chunks(batch.column(1)):
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            for i in range(chunk.texts):
                own = chunk.data[chunk.offsets[i]:chunk.offsets[i + 1]]
                a, b = bounds[chunk.first + i], bounds[chunk.first + i + 1]
                n, spans = 0, 0
                kept = own
                if b > a:
                    hit, spans = removed(own, first[a:b], last[a:b])
                    n, kept = int(hit.sum()), own[~hit]
                for k, v in zip(out, (len(own), n, spans, kept.tobytes())):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column(0).slice(chunk.first, chunk.texts),
                **{k: pa.array(v, pa.int64()) for k, v in out.items() if k != "kept"},
                "kept": pa.array(out["kept"], pa.binary())})


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut(batches):
        kept = pa.array([hashlib.sha256(x).hexdigest() for x in batch.column(4).to_pylist()])
        yield batch.set_column(4, "kept_sha256", kept)


def _ranks(rows: DataFrame) -> DataFrame:
    """The rows with `source`: whether they start first of their (name, run)."""
    place = F.struct("id", "tie", "first")
    sources = rows.groupBy("name", "run").agg(F.min(place).alias("place"))
    return rows.join(sources, ["name", "run"]).withColumn("source", place == F.col("place")).drop("place")


def repeated_spans(docs: DataFrame, length: int = 100) -> DataFrame:
    """(id, tie, spans): the repeated bytes of those of the rows (id, tie, text) that have any."""
    runs = docs.mapInArrow(_runs(length), _PLACED)
    again = runs.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name")
    ranked = written(_ranks(written(runs.join(again, "name"), "runs")), "ranked")
    found = ranked.filter("NOT source").select("id", "tie", "first", (F.col("last") + length).alias("last"))

    firsts = ranked.filter("source").dropDuplicates(["name", "run"])
    open_names = written(firsts.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "open")

    def contexts(names: DataFrame) -> DataFrame:
        opened = written(firsts.join(names, "name", "left_semi").groupBy("id", "tie").agg(
            F.collect_list(F.struct("first", "last", "name")).alias("runs")).toDF("i", "t", "runs"), "opened")
        texts = docs.join(small_side(opened.select("i").distinct()), F.col("id") == F.col("i"), "left_semi")
        return (texts.join(opened, (F.col("id") == F.col("i")) & (F.col("tie") == F.col("t")))
                .select("id", "tie", "text", "runs").mapInArrow(_contexts(length), _CONTEXT))

    few = contexts(open_names.filter(F.col("n") <= PLACES))
    found = found.union(few.repartition("name").sortWithinPartitions("name", "id", "tie", "first").mapInArrow(
        _ranked(length), "id long, tie int, first long, last long"))
    many = open_names.filter(F.col("n") > PLACES)
    if not many.isEmpty():
        windows = contexts(many).mapInArrow(_windows(length), "id long, tie int, first long, name long, run long")
        found = found.union(_ranks(written(windows, "windows")).filter("NOT source")
                            .select("id", "tie", "first", (F.col("first") + length).alias("last")))
    return found.groupBy("id", "tie").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, tie, text). Only ids that repeat need a hash of the text to tell their rows apart."""
    own = F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST))
    filled = F.coalesce(F.col(text), F.lit(""))
    again = (docs.groupBy(own.alias("r")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("r"))
    tie = F.xxhash64("text").bitwiseAND(F.lit(2**31 - 1)).cast("int")
    return (docs.select(own.alias("id"), filled.alias("text"))
            .join(small_side(again), F.col("id") == F.col("r"), "left")
            .select("id", F.when(F.col("r").isNull(), 0).otherwise(tie).alias("tie"), "text"))


def _with_spans(named: DataFrame, length: int) -> DataFrame:
    """(id, text, spans) of all documents. Texts without any go through no join on a large side."""
    spans = written(repeated_spans(named, length).toDF("i", "t", "spans"), "spans")
    ids = small_side(spans.select("i").distinct())
    none = F.expr("cast(array() as array<struct<first:long,last:long>>)")
    whole = named.join(ids, F.col("id") == F.col("i"), "left_anti").select("id", "text", none.alias("spans"))
    some = (named.join(ids, F.col("id") == F.col("i"), "left_semi")
            .join(spans, (F.col("id") == F.col("i")) & (F.col("tie") == F.col("t")), "left")
            .select("id", "text", F.coalesce("spans", none).alias("spans")))
    return whole.union(some)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    length: int = 100) -> DataFrame:
    """Per document: `doc_id`, `n_bytes`, `n_removed`, `n_spans` and the `kept` bytes."""
    out = _with_spans(_named(docs, doc_id, text), length).mapInArrow(
        _cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumn("id", F.when(F.col("id") != _LAST, F.col("id"))).withColumnRenamed("id", "doc_id")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """Per document: `doc_id`, `n_bytes`, `n_removed`, `n_spans` and the digest of the kept bytes."""
    out = _with_spans(_named(docs, doc_id, text), length).mapInArrow(
        _digested, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumn("id", F.when(F.col("id") != _LAST, F.col("id"))).withColumnRenamed("id", "doc_id")
