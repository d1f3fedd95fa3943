"""Benchmark decontamination by FM-index.

Test phrases are the windows of 10 consecutive words of each benchmark text (A-Z in lower case; a
shorter text is one window). Spark tasks cut the documents into shards of a few MB of whole texts,
index each shard's words, look all phrases up by backward search, locate the occurrences, and merge
them to spans of words per document. Texts never leave their task.

The phrases are a stated query set. They are cut into blocks of bounded size; each block is sent to
all tasks, and each further block is a further pass that adds its spans to those found before.

Null or empty texts have no words and no hits. An item without words has no windows. Items that
repeat count once; a null item id is listed as an empty string. Rows that repeat a doc_id are judged
by their own texts. No items or no documents are fine. Only the named columns are read, so others
cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.llm import text as T
from ledgerlake.llm.fm_index import FMIndex
from ledgerlake.llm.rows import whole_row
from ledgerlake.sources.workspace import written

WINDOW = 10
#: Windows of one block: 200,000 of 10 words of 8 bytes are 16 MB.
BLOCK_WINDOWS = 200_000
SHARD_BYTES = 2 << 20


def _tokens(chunk: T.Chunk) -> tuple[np.ndarray, T.Words]:
    data = T.lower(chunk.data)
    found = T.words(T.Chunk(chunk.first, data, chunk.offsets), T.ALNUM)
    return T.Hasher(data)(found.starts, found.ends), found


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, words): every window of every item, as the hashes of its words."""
    for batch in batches:
        items = batch.column(0).to_pylist()
        for chunk in T.chunks(batch.column(1)):
            tokens, found = _tokens(chunk)
            out = set()
            for i in range(chunk.texts):
                own = tokens[found.offsets[i]:found.offsets[i + 1]]
                for at in range(max(1, len(own) - WINDOW + 1) if len(own) else 0):
                    out.add((items[chunk.first + i], own[at:at + WINDOW].tobytes()))
            rows = sorted(out)
            yield pa.RecordBatch.from_pydict({
                "item": pa.array([r[0] for r in rows], pa.string()),
                "words": pa.array([r[1] for r in rows], pa.binary())})


class Phrases:
    """A block of windows: their words by number, grouped by length, and the items they are from."""

    def __init__(self, rows: list[tuple[str, bytes]]):
        self.items = sorted({r[0] for r in rows})
        number = {x: i for i, x in enumerate(self.items)}
        of: dict[bytes, set[int]] = {}
        for item, words in rows:
            of.setdefault(words, set()).add(number[item])
        hashes = {w: np.frombuffer(w, np.uint64) for w in of}
        self.known = np.unique(np.concatenate([*hashes.values(), np.zeros(0, np.uint64)]))
        self.by_length: list[tuple[int, np.ndarray, list[list[int]]]] = []
        for n in sorted({len(h) for h in hashes.values()}):
            own = sorted(w for w, h in hashes.items() if len(h) == n)
            symbols = np.searchsorted(self.known, np.stack([hashes[w] for w in own])) + 1
            self.by_length.append((n, symbols, [sorted(of[w]) for w in own]))

    def symbols(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self.known, tokens), len(self.known) - 1)
        return np.where(self.known[at] == tokens, at + 1, 0)

    def find(self, tokens: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[int]]]:
        """(length, first words, items) of each window that occurs."""
        symbols = self.symbols(tokens)
        # a shard's text: each document's words, then a sentinel; runs of unknown words are one
        text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        spread = np.zeros(len(tokens) + len(offsets) - 1, np.int64)
        spread[np.arange(len(tokens)) + text_of] = symbols
        words = np.full(len(spread), -1, np.int64)
        words[np.arange(len(tokens)) + text_of] = np.arange(len(tokens))
        keep = np.ones(len(spread), bool)
        keep[1:] = (spread[1:] > 0) | (spread[:-1] > 0)
        spread, words = spread[keep], words[keep]
        if not len(spread) or not self.by_length:
            return
        index = FMIndex(spread, len(self.known))
        for n, phrases, items in self.by_length:
            low, high = index.search(phrases)
            hit = np.flatnonzero(high > low)
            counts = high[hit] - low[hit]
            rows = np.repeat(low[hit] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
            places = words[index.locate(rows + np.arange(counts.sum()))]
            for i, own in zip(hit, np.split(places, np.cumsum(counts)[:-1])):
                yield n, own, items[i]


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _spans(hit: np.ndarray, offsets: np.ndarray) -> list[list[dict]]:
    """The maximal runs of hit words of each text."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    goes_on = hit[1:] & hit[:-1] & (text[1:] == text[:-1])
    firsts = np.flatnonzero(hit & ~np.concatenate([[False], goes_on])[:len(hit)])
    lasts = np.flatnonzero(hit & ~np.concatenate([goes_on, [False]])[:len(hit)]) + 1
    out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    for t, a, b in zip(text[firsts], firsts, lasts):
        out[t].append({"first": int(a - offsets[t]), "last": int(b - offsets[t])})
    return out


def _searched(phrases):
    """Adds what a block of phrases hits to what the blocks before it did."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = phrases.value
        for batch in batches:
            known_spans, known_items = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for chunk in T.chunks(batch.column(1), SHARD_BYTES):
                rows = slice(chunk.first, chunk.first + chunk.texts)
                tokens, found = _tokens(chunk)
                items = [set(x) for x in known_items[rows]]
                change = np.zeros(len(tokens) + 1, np.int64)
                for n, places, own in block.find(tokens, found.offsets):
                    np.add.at(change, places, 1)
                    np.add.at(change, places + n, -1)
                    for text in np.unique(np.searchsorted(found.offsets, places, "right") - 1):
                        items[text].update(block.items[i] for i in own)
                for start, spans in zip(found.offsets, known_spans[rows]):
                    for x in spans:
                        change[start + x["first"]] += 1
                        change[start + x["last"]] -= 1
                hit = np.cumsum(change[:-1]) > 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.texts),
                     batch.column(1).slice(chunk.first, chunk.texts),
                     pa.array(np.diff(found.offsets), pa.int64()),
                     pa.array(_spans(hit, found.offsets), _SPANS),
                     pa.array([sorted(s) for s in items], pa.list_(pa.string()))],
                    ["key", "text", "n_words", "spans", "items"])
    return run


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document: `key`, `n_words`, `spans` (of hit words: first, last + 1) and `items`, sorted.

    `key` may be any column, a struct of all columns included.
    """
    spark = docs.sparkSession
    phrases = written(
        items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                     F.col(item_text).alias("text"))
        .mapInArrow(_windows, "item string, words binary").distinct(), "phrases")
    blocks = max(1, -(-phrases.count() // block_windows))
    dealt = phrases.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    spans = StructType.fromDDL("n_words long, spans array<struct<first:long,last:long>>, items array<string>")
    state = StructType([StructField("key", docs.schema[key].dataType), StructField("text", StringType()), *spans])
    found = docs.select(F.col(key).alias("key"), F.col(text).alias("text"),
                        F.lit(0).cast("long").alias("n_words"),
                        F.expr("cast(array() as array<struct<first:long,last:long>>)").alias("spans"),
                        F.expr("cast(array() as array<string>)").alias("items"))
    for i in range(blocks):
        if i:
            found = written(found, "searched")
        block = Phrases([(r.item, bytes(r.words)) for r in
                         dealt.filter(F.col("block") == i).select("item", "words").toLocalIterator()])
        found = found.mapInArrow(_searched(spark.sparkContext.broadcast(block)), state)
    return found.drop("text")


def report(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: words, hit words, items found and their digest, and the verdict."""
    found = contamination(docs, items, doc_id, text, item_id, item_text)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(F.col("key").alias("doc_id"), "n_words", hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text") -> DataFrame:
    """The documents without a hit, with all their columns."""
    flat = docs.select(whole_row(docs).alias("__row"), F.col(text).alias("__text"))
    found = contamination(flat, items, "__row", "__text", item_id, item_text)
    return found.filter(F.size("spans") == 0).select("key.*")
