"""Ranked lexical search: the best documents for each of a set of texts, by presence masks.

Words are runs of ASCII letters and digits and of all beyond ASCII, A-Z in lower case. The items are
a stated query set, cut into blocks of bounded size; each block is sent to all tasks and read against
all documents in two passes.

The first pass counts documents, words and, for each word of the block, the documents that hold it.
The second takes documents a chunk at a time. Presence bits of an item's words group the chunk's
documents by mask: all that hold the same words are one group. A mask bounds the score of its group,
by the greatest count that each word has in the chunk and the least length. Masks are evaluated from
the highest bound down until ten documents found so far, in this task, all score more than the next
bound; no document that is left can then be among the ten best. Each task sends its ten best per
item, so the last step sees ten rows per task and item, in two stages.

Scores are integers (see `weight` and `share`); equal scores rank by ascending id, null ids last.
Words are told apart by 64-bit hashes. A null or empty text, or one without words, is never found
and does not count as a document; an item without words finds nothing. Items that repeat are ranked
each by itself, also with a null id; documents that repeat are found as often as they are there. No
items or no documents: no rows. Very long texts are read whole, a chunk of their own; the groups of a
long item are formed for so many documents at a time that their bits fit. Only the named columns are
read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import text as T
from ledgerlake.sources.workspace import written

BEST = 10
#: Distinct words of one block's items, counted per item: 100,000 of 16 bytes.
BLOCK_WORDS = 100_000
CHUNK_BYTES = 4 << 20
#: Presence bits held at once for one item, before packing.
CELLS = 4 << 20


def _words(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and where each text's words begin."""
    data = T.lower(chunk.data)
    found = T.words(T.Chunk(chunk.first, data, chunk.offsets), T.ALNUM)
    return T.Hasher(data, 3)(found.starts, found.ends), found.offsets


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, words, times): an item's distinct words, with how often it holds each."""
    for batch in batches:
        for chunk in T.chunks(batch.column(1)):
            hashes, offsets = _words(chunk)
            counted = [np.unique(hashes[a:b], return_counts=True) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(chunk.first, chunk.texts),
                 pa.array([w.tobytes() for w, _ in counted], pa.binary()),
                 pa.array([n.astype(np.int64).tobytes() for _, n in counted], pa.binary())],
                ["item", "words", "times"])


class Block(NamedTuple):
    """Some items, over the distinct words of all of them."""
    items: list[int]
    words: np.ndarray
    own: list[np.ndarray]
    """Of each item, the numbers of its words."""
    times: list[np.ndarray]


def _block(rows: list) -> Block:
    hashes = [np.frombuffer(r.words, np.uint64) for r in rows]
    words = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
    return Block([r.item for r in rows], words, [np.searchsorted(words, h) for h in hashes],
                 [np.frombuffer(r.times, np.int64) for r in rows])


class Postings(NamedTuple):
    """The words of a block in the documents of a chunk, by word."""
    docs: np.ndarray
    times: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray
    """Words of each document, of the block or not."""


def _postings(words: np.ndarray, chunk: T.Chunk) -> Postings:
    hashes, offsets = _words(chunk)
    lengths = np.diff(offsets)
    doc = np.repeat(np.arange(chunk.texts), lengths)
    at = np.minimum(np.searchsorted(words, hashes), max(len(words) - 1, 0))
    known = words[at] == hashes if len(words) else np.zeros(len(hashes), bool)
    pairs, times = np.unique(at[known] * chunk.texts + doc[known], return_counts=True)
    word = pairs // max(chunk.texts, 1)
    return Postings(pairs - word * chunk.texts, times, np.searchsorted(word, np.arange(len(words) + 1)), lengths)


def _counted(block):
    """(word, n): how many documents of one task hold each word; -2 counts documents, -1 words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = block.value.words
        docs = total = 0
        holding = np.zeros(len(words), np.int64)
        for batch in batches:
            for chunk in T.chunks(batch.column(1), CHUNK_BYTES):
                found = _postings(words, chunk)
                docs += int((found.lengths > 0).sum())
                total += int(found.lengths.sum())
                holding += np.diff(found.offsets)
        held = np.flatnonzero(holding)
        yield pa.RecordBatch.from_pydict({
            "word": pa.array(np.concatenate([[-2, -1], held])),
            "n": pa.array(np.concatenate([[docs, total], holding[held]]))})
    return run


def weight(n_docs: int, holding: np.ndarray) -> np.ndarray:
    """What a word that so many of all documents hold is worth."""
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * holding + 1))).astype(np.int64)


def lengths_of(lengths: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """The length of each document in hundredths of the mean, of which a quarter is fixed."""
    return 25 + (75 * lengths * n_docs) // max(n_words, 1)


def share(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What so many occurrences add of a word's worth, in millionths."""
    return (1_000_000_000 * times) // (1000 * times + 8 * m)


class Best:
    """The best documents of an item so far, in one task."""

    def __init__(self, best: int):
        self.best = best
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        """A document that scores less is not among the best."""
        return int(self.scores[-1]) if len(self.scores) == self.best else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[:self.best]
        self.scores, self.ids = scores[order], ids[order]


#: Stands for a null id, so that it sorts last; an id cannot be that large and null both.
_NULL = np.iinfo(np.int64).max


def _masks(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct columns of presence bits: the first place of each, and which one each column is."""
    bits = np.ascontiguousarray(np.packbits(present, axis=0).T)
    if bits.shape[1] <= 8:
        keys = np.zeros((len(bits), 8), np.uint8)
        keys[:, :bits.shape[1]] = bits
        keys = keys.view(np.uint64).ravel()
    else:
        keys = bits.view(np.dtype((np.void, bits.shape[1]))).ravel()
    _, first, which = np.unique(keys, return_index=True, return_inverse=True)
    return first, which.ravel()


def _evaluate(best: Best, own: np.ndarray, worth: np.ndarray, found: Postings, m: np.ndarray,
              ids: np.ndarray) -> None:
    """Add a chunk's documents to the best of one item, mask by mask, until the rest cannot count."""
    counts = found.offsets[own + 1] - found.offsets[own]
    there = np.flatnonzero((counts > 0) & (worth > 0))
    if not len(there):
        return
    own, worth, counts = own[there], worth[there], counts[there]
    row = np.repeat(np.arange(len(own)), counts)
    place = np.repeat(found.offsets[own] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    doc, times = found.docs[place], found.times[place]
    least = m[found.lengths > 0].min()
    most = worth * share(np.maximum.reduceat(times, np.cumsum(counts) - counts), least)
    if most.sum() < best.floor:
        return
    step = max(1, CELLS // len(own))
    for low in range(0, len(m), step):
        size = min(step, len(m) - low)
        inside = (doc >= low) & (doc < low + size)
        present = np.zeros((len(own), size), bool)
        present[row[inside], doc[inside] - low] = True
        first, which = _masks(present)
        bounds = most @ present[:, first]
        order = np.argsort(-bounds, kind="stable")
        by_mask = np.argsort(which, kind="stable")
        edges = np.searchsorted(which[by_mask], np.arange(len(first) + 1))
        matrix = None
        for mask in order:
            if bounds[mask] < best.floor or not bounds[mask]:
                break
            if matrix is None:
                matrix = np.zeros((len(own), size), np.int64)
                matrix[row[inside], doc[inside] - low] = times[inside]
            group = by_mask[edges[mask]:edges[mask + 1]]
            held = np.flatnonzero(present[:, first[mask]])
            scores = worth[held] @ share(matrix[np.ix_(held, group)], m[low + group])
            good = scores >= best.floor
            best.add(scores[good], ids[low + group[good]])


def _searched(block, worths, n_docs: int, n_words: int, best: int):
    """(item, doc_id, score, part): the best of each item among one task's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said = block.value
        found_best = [Best(best) for _ in said.items]
        for batch in batches:
            ids = batch.column(0).fill_null(_NULL).to_numpy()
            for chunk in T.chunks(batch.column(1), CHUNK_BYTES):
                found = _postings(said.words, chunk)
                if not found.lengths.any():
                    continue
                m = lengths_of(found.lengths, n_docs, n_words)
                own_ids = ids[chunk.first:chunk.first + chunk.texts]
                for b, own, worth in zip(found_best, said.own, worths.value):
                    _evaluate(b, own, worth, found, m, own_ids)
        n = [len(b.scores) for b in found_best]
        ids = np.concatenate([*(b.ids for b in found_best), np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(said.items, np.int64), n)), pa.array(ids, mask=ids == _NULL),
             pa.array(np.concatenate([*(b.scores for b in found_best), np.zeros(0, np.int64)])),
             pa.array(np.full(sum(n), TaskContext.get().partitionId(), np.int32))],
            ["item", "doc_id", "score", "part"])
    return run


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", best: int = BEST,
           block_words: int = BLOCK_WORDS) -> DataFrame:
    """`item_id`, `rank` (from 1), `doc_id` and `score` of each item's `best` documents above 0."""
    spark = docs.sparkSession
    numbered = written(items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
                       .withColumn("item", F.monotonically_increasing_id()), "items")
    asked = written(numbered.select("item", "text")
                    .mapInArrow(_items, "item long, words binary, times binary")
                    .filter(F.octet_length("words") > 0), "asked")
    total = asked.agg(F.sum(F.octet_length("words") / 8)).first()[0] or 0
    blocks = max(1, -(-int(total) // block_words))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for i in range(blocks):  # one block of the query set at a time; all documents against each
        block = _block(dealt.filter(F.col("block") == i).orderBy("item").collect())
        shared = spark.sparkContext.broadcast(block)
        counts = dict(map(tuple, rows.mapInArrow(_counted(shared), "word long, n long")
                          .groupBy("word").agg(F.sum("n")).collect()))
        holding = np.array([counts.get(k, 0) for k in range(len(block.words))], np.int64)
        n_docs, n_words = counts.get(-2, 0), counts.get(-1, 0)
        worth = weight(n_docs, holding)
        worths = [worth[own] * times for own, times in zip(block.own, block.times)]
        run = _searched(shared, spark.sparkContext.broadcast(worths), n_docs, n_words, best)
        own = rows.mapInArrow(run, "item long, doc_id long, score long, part int")
        own = own if blocks == 1 else written(own, "found")
        found = own if found is None else found.unionByName(own)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("item", F.pmod("part", F.lit(32))).orderBy(*order)
    few = found.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= best)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return (ranked.filter(F.col("rank") <= best).join(numbered.select("item", "item_id"), "item")
            .select("item_id", "rank", "doc_id", "score"))
