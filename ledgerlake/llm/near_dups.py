"""Near-duplicates by bottom-k sketches of word shingles.

A document's set holds the hashes of its distinct 5-word shingles (A-Z in lower case; a shorter text
is one shingle). Its sketch is the k smallest values of the set, so one hash function serves all.

1. Documents with equal sets are one class; the smallest id stands for it.
2. Inverted lists: value -> documents that retain it. Linked documents share at least `_shared` of
   their retained values but for one case in about 10^8, so a document enters only the lists of its
   rarest values, as many as it takes to have one of any `_shared` in common. Values that only it
   retains count and make no list. Thus passages that very many documents share make no long lists.
3. Every document of a list is paired with the list's smallest one. Pairs whose sketches' union puts
   them far below the threshold are left out; the others are verified on full sets.
4. Verified links give components. Documents that the lists join but no link does are compared
   further, those outside the largest component of such a cluster with all others, in blocks and on
   full sets. Documents that are connected already need no further pair, and one link to each other
   component is kept, so a group of near copies gives about as many rows as it has members.

Links are confirmed exactly; no list, pair or document is capped or dropped. Null text, or text
without words, has an empty set and no links. A null id comes last and never stands for others.
Rows that repeat an id are judged by their own texts. No documents: no rows. Only the named columns
are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import text as T
from ledgerlake.llm.graph import components
from ledgerlake.llm.rows import whole_row
from ledgerlake.llm.sizes import small_side
from ledgerlake.sources.workspace import written

SIZE = 5
RETAINED = 64
LEAST_SHARED = 28
#: Documents with at most this many shingles are compared on whole sets by their sketches.
WHOLE = 48
BLOCK = 1024
_LAST = 2**63 - 1
_PAD = np.uint64(2**64 - 1)


def shingle_sets(chunk: T.Chunk) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = T.lower(chunk.data)
    found = T.words(T.Chunk(chunk.first, data, chunk.offsets), T.SPACED)
    tokens = T.Hasher(data)(found.starts, found.ends)
    by_size = {n: T.window_hashes(tokens, n, n) for n in range(1, SIZE + 1)}
    out = []
    for a, b in zip(found.offsets[:-1].tolist(), found.offsets[1:].tolist()):
        n = min(b - a, SIZE)
        out.append(np.unique(by_size[n][a:b - n + 1]) if n else np.zeros(0, np.uint64))
    return out


def _signature(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for chunk in T.chunks(batch.column(1)):
            sets = shingle_sets(chunk)
            yield pa.RecordBatch.from_pydict({
                "id": ids.slice(chunk.first, chunk.texts),
                "tie": batch.column(2).slice(chunk.first, chunk.texts),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "class": pa.array([_signature(s) for s in sets], pa.binary()),
                "sketch": pa.array([s[:RETAINED].tobytes() for s in sets], pa.binary())})


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, id, n) of each retained value."""
    for batch in batches:
        flat = batch.column(1).cast(pa.large_binary())
        values = [np.frombuffer(s, np.int64) for s in flat.to_pylist()]
        counts = np.array([len(v) for v in values], np.int64)
        yield pa.RecordBatch.from_pydict({
            "value": pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)),
            "id": pa.array(np.repeat(batch.column(0).to_numpy(), counts)),
            "n": pa.array(np.repeat(batch.column(2).to_numpy(), counts))})


def _lists(classes: DataFrame) -> DataFrame:
    """(value, id): the lists that each document enters, those of its rarest shared values."""
    retained = classes.select("id", "sketch", "n").mapInArrow(_values, "value long, id long, n long")
    shared = retained.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    least = F.when(F.col("n") <= WHOLE, F.ceil(0.75 * F.col("n"))).otherwise(LEAST_SHARED)
    mine = (retained.join(shared, "value").groupBy("id", "n")
            .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("own")))
    take = F.greatest(F.size("own") - least + 1, F.lit(0)).cast("int")
    return (mine.select("id", F.explode(F.slice("own", F.lit(1), take)).alias("x"))
            .select("x.value", "id"))


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity by the k smallest values of the union, for each pair of padded sketches."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    again = np.zeros(both.shape, bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != _PAD)
    rank = np.cumsum(~again & (both != _PAD), axis=1)
    full = np.minimum((a != _PAD).sum(1), (b != _PAD).sum(1)) >= RETAINED
    whole = rank[:, -1]
    seen = np.where(full | (whole > RETAINED), np.minimum(whole, RETAINED), whole)
    return (again & (rank <= seen[:, None])).sum(1) / np.maximum(seen, 1)


def _padded(sketches: list[bytes]) -> np.ndarray:
    out = np.full((len(sketches), RETAINED), _PAD)
    for row, s in zip(out, sketches):
        v = np.frombuffer(s, np.uint64)
        row[:len(v)] = v
    return out


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            a, b = (_padded(part.column(i).to_pylist()) for i in (2, 3))
            ok = pa.array(estimate(a, b) >= LEAST_SHARED / RETAINED)
            yield part.select(["a", "b"]).filter(ok)


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, set) of the rows whose text is the one that the class was made from."""
    for batch in batches:
        ids, wanted = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for chunk in T.chunks(batch.column(1)):
            rows = [(ids[chunk.first + i], s.tobytes())
                    for i, s in enumerate(shingle_sets(chunk))
                    if _signature(s) == wanted[chunk.first + i]]
            yield pa.RecordBatch.from_pydict({
                "id": pa.array([r[0] for r in rows], pa.int64()),
                "set": pa.array([r[1] for r in rows], pa.binary())})


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, of two sorted arrays without repeats."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            ok = [similar(np.frombuffer(left[i].as_buffer(), np.uint64),
                          np.frombuffer(right[i].as_buffer(), np.uint64), percent)
                  for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _links(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are similar."""
    def of(frame: DataFrame, value: str, side: str) -> DataFrame:
        return frame.select(F.col("id").alias(side), F.col(value).alias(f"of_{side}"))

    def carried(frame: DataFrame, value: str, to: DataFrame) -> DataFrame:
        both = to.join(of(frame, value, "b"), "b").join(of(frame, value, "a"), "a")
        return both.select("a", "b", "of_a", "of_b")

    hopeful = carried(classes, "sketch", pairs).mapInArrow(_plausible, "a long, b long")
    return carried(sets, "set", hopeful).mapInArrow(_verified(percent), "a long, b long").distinct()


def _across(percent: int):
    """Similar pairs of a block's members and some documents outside the largest component.

    One link to each other component will do, so a document adds no more rows than those.
    """
    def run(table: pa.Table) -> pa.Table:
        stray = np.array(table.column("stray").to_pylist(), bool)
        ids, comps = (table.column(c).to_numpy() for c in ("id", "component"))
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("set")]
        sizes = np.array([len(s) for s in sets])
        sketches = _padded([s[:RETAINED].tobytes() for s in sets])
        held = (sketches != _PAD).sum(1)
        members = np.flatnonzero(~stray)
        out: list[tuple[int, int]] = []
        for s in np.flatnonzero(stray):
            near = members[(comps[members] != comps[s])
                           & (100 * np.minimum(sizes[members], sizes[s])
                              >= percent * np.maximum(sizes[members], sizes[s]))]
            own = sketches[s][:held[s]]
            at = np.minimum(np.searchsorted(own, sketches[near]), held[s] - 1)
            shared = ((own[at] == sketches[near]) & (sketches[near] != _PAD)).sum(1)
            near = near[shared * RETAINED >= LEAST_SHARED * np.minimum(held[near], held[s])]
            if not len(near):
                continue
            flat = np.concatenate([sets[x] for x in near])
            at = np.minimum(np.searchsorted(sets[s], flat), sizes[s] - 1)
            starts = np.cumsum(sizes[near]) - sizes[near]
            common = np.add.reduceat((sets[s][at] == flat).astype(np.int64), starts)
            ok = near[100 * common >= percent * (sizes[near] + sizes[s] - common)]
            _, firsts = np.unique(comps[ok], return_index=True)
            out += [(int(ids[s]), int(ids[x])) for x in ok[firsts]]
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()),
                         "b": pa.array([x[1] for x in out], pa.int64())})
    return run


def _links_across(pairs: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between documents that some chain of lists joins, but no verified link yet.

    Documents that share a list share its hub, so they are in one component of the pairs with hubs.
    Where such a cluster has several verified components, those outside its largest one meet all
    others, block by block; a set travels once for each block that it meets.
    """
    rows = (components(pairs).select(F.col("node").alias("id"), F.col("component").alias("cluster")))
    rows = rows.union(rows.select("cluster", "cluster").distinct())
    known = labels.select(F.col("node").alias("id"), "component")
    rows = written(rows.join(known, "id", "left")
                   .withColumn("component", F.coalesce("component", "id")), "clusters")
    by_component = rows.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"))
    main = (by_component.groupBy("cluster").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.sum("n").alias("n"), F.max("n").alias("most")).filter("most < n")
        .select("cluster", "main", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
                F.ceil((F.col("n") - F.col("most")) / BLOCK).cast("int").alias("stray_blocks")))
    rows = rows.join(main, "cluster").join(sets, "id")

    def block(n: str):
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ("cluster", "id", "component", "set")
    members = (rows.withColumn("block", block("blocks")).withColumn("turn", every("stray_blocks"))
               .select(*columns, "block", "turn", F.lit(False).alias("stray")))
    strays = (rows.filter("component <> main").withColumn("turn", block("stray_blocks"))
              .withColumn("block", every("blocks"))
              .select(*columns, "block", "turn", F.lit(True).alias("stray")))
    return (members.union(strays).groupBy("cluster", "block", "turn")
            .applyInArrow(_across(percent), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    percent: int = 75) -> DataFrame:
    """Per document: `doc_id`, `n_shingles`, `component_id` and `kept` (it stands for its group).

    `percent` of 75 or more; the sketches are made for that.
    """
    return _grouped(docs, doc_id, text, percent).drop("tie")


def _grouped(docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    if percent < 75:
        raise ValueError("the sketches serve similarities of 75 percent or more")
    named = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("id"),
                        F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    rows = written(named.mapInArrow(_sketched, "id long, tie long, n long, class binary, sketch binary"),
                   "sketches")
    classes = written(rows.filter("n > 0").groupBy("class")
                      .agg(F.min(F.struct("id", "n", "sketch")).alias("x"))
                      .select("class", "x.id", "x.n", "x.sketch"), "classes")
    lists = _lists(classes)
    listed = lists.groupBy("value").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n"))
    lists = written(lists.join(listed.filter("n > 1"), "value"), "lists")
    involved = (classes.select("id", "class")
                .join(lists.select("id").distinct(), "id", "left_semi")
                .select(F.col("id").alias("i"), "class"))
    texts = named.join(small_side(involved), F.col("id") == F.col("i")).select("id", "text", "class")
    sets = written(texts.mapInArrow(_set_rows, "id long, set binary"), "sets")

    pairs = written(lists.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b"))
                    .distinct(), "pairs")
    links = written(_links(pairs, classes, sets, percent), "verified")
    more = written(_links_across(pairs, components(links), sets, percent), "more-verified")
    labels = components(links.union(more))

    reached = (classes.select("class", F.col("id").alias("node")).join(labels, "node", "left")
               .select(F.col("class").alias("of"), F.coalesce("component", "node").alias("component")))
    own = F.when(F.col("id") != _LAST, F.col("id"))
    group = F.coalesce("component", "id")
    return (rows.select("id", "tie", "n", "class").join(reached, F.col("class") == F.col("of"), "left")
            .select(own.alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(group != _LAST, group).alias("component_id"),
                    (group == F.col("id")).alias("kept"), "tie"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                percent: int = 75) -> DataFrame:
    """The documents that stand for their groups, with all their columns.

    Of rows that repeat such an id, one stays; rows without an id stay once per text.
    """
    kept = (_grouped(docs, doc_id, text, percent).filter("kept")
            .select(F.coalesce("doc_id", F.lit(_LAST)).alias("__id"), F.col("tie").alias("__tie"))
            .distinct())
    rows = docs.select(whole_row(docs).alias("__row"), F.xxhash64(text).alias("__tie"),
                       F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("__id"))
    own = F.when(F.col("__id") == _LAST, F.col("__tie"))
    return (rows.join(kept, ["__id", "__tie"], "left_semi").withColumn("__own", own)
            .dropDuplicates(["__id", "__own"]).select("__row.*"))
