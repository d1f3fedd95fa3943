"""Scores of texts by a class-based bigram model with exchange clustering.

A text is its words (A-Z in lower case) and then one end; it begins as if after an end. The model is
P(word | before) = P(class | class before) * P(word | class).

1. Tasks cut the texts into shards of about a hundred thousand words of whole texts and write each as numbers
   of its own word list. What is shuffled afterwards are rows of (shard, word), not words of text.
2. Word counts over all training texts. The most frequent words (a fixed number) are clustered by
   exchange on the driver: each word in turn moves to the class that raises the likelihood of the class
   bigrams most. Their bigram counts come from all training texts; this start sees a small table.
3. Rounds of exchange over every word that training has often enough (at least a fixed count, so they
   grow with the input). Classes are sent to all tasks, or joined to the shards' word lists where they
   are too many; tasks count (word, class of its neighbour), sum that over their shards and pack it in
   blocks by a hash of the word; all blocks of a bucket of words meet in one task. All of these words move
   at once, each to the class that raises the likelihood most with the others as they were; tasks choose
   in batches and see the table of class bigrams only. The new classes are written each round.
4. Rarer words get, in the last round, the class that explains all their neighbours best. Only words
   whose neighbours all have no class yet share a class.
5. Counts and final classes are sent or joined to the shards likewise. Class bigrams are counted over all
   training texts, and the texts scored, shard by shard.

Class transitions are smoothed towards the frequencies of classes; a word that training never saw
takes the share of words seen once. Emissions add 0.1 to each count.

Null text is empty: one end. Rows that repeat count and are scored one by one. Without training
texts every score is 0. No documents: no rows. Only the named columns are read, so others cannot
clash. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import text as T
from ledgerlake.sources.folders import drop
from ledgerlake.sources.workspace import written

END = np.uint64(1)
SHARD_TOKENS = 1 << 17
FREQUENT = 512
CLASSES = 32
LEAST = 5
ROUNDS = 3
#: Words whose classes are sent to all tasks: 4 million of 18 bytes. More are joined to the shards.
LOOKUP_WORDS = 4_000_000
#: Texts, shards and blocks that a task gets at once; a larger one comes alone.
BATCH_BYTES = 2 << 20
#: Rows that Spark reads at once.
BATCH_ROWS = 8
ADD = 0.1
_CLASS = 1024
SMOOTH = 50.0

_SHARD = ("shard long, ids array<long>, train binary, lengths binary, low binary, high binary,"
          " words binary, counts binary")


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards: ids of the texts, their lengths, and all words by number in the shard's word list."""
    number = TaskContext.get().partitionId() << 32
    ids, train, lengths, tokens, n = [], [], [], [], 0
    for batch in batches:
        for chunk in T.chunks(batch.column(1)):
            data = T.lower(chunk.data)
            found = T.words(T.Chunk(chunk.first, data, chunk.offsets), T.SPACED)
            own = np.insert(T.Hasher(data)(found.starts, found.ends), found.offsets[1:], END)
            ids += batch.column(0).slice(chunk.first, chunk.texts).to_pylist()
            train += batch.column(2).slice(chunk.first, chunk.texts).to_pylist()
            lengths.append(np.diff(found.offsets) + 1)
            tokens.append(own)
            n += len(own)
            if n >= SHARD_TOKENS:
                yield _shard(number, ids, train, lengths, tokens)
                number += 1
                ids, train, lengths, tokens, n = [], [], [], [], 0
    if n:
        yield _shard(number, ids, train, lengths, tokens)


def _shard(number: int, ids: list, train: list, lengths: list, tokens: list) -> pa.RecordBatch:
    lengths, trained = np.concatenate(lengths), np.array(train, bool)
    words, which, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")  # small numbers for common words pack well
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    which = place[which]
    learned = np.bincount(which[np.repeat(trained, lengths)], minlength=len(words))
    raw = (trained.astype(np.uint8), lengths, which.astype(np.uint16), (which >> 16).astype(np.uint8),
           words[order], learned)
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
         *(pa.array([x.tobytes()], pa.binary()) for x in raw)],
        [c.split()[0] for c in _SHARD.split(", ")])


@dataclass
class Shard:
    number: int
    ids: list
    train: np.ndarray
    lengths: np.ndarray
    tokens: np.ndarray
    words: np.ndarray | None
    counts: np.ndarray | None

    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.lengths)[:-1]])

    def before(self, values: np.ndarray, end) -> np.ndarray:
        """What stands before each token; an end before the first of a text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.starts()] = end
        return out

    def learned(self) -> np.ndarray:
        return np.repeat(self.train, self.lengths)


def _shards(batch: pa.RecordBatch) -> Iterator[tuple[int, Shard]]:
    for i in range(batch.num_rows):
        def raw(name: str, kind):
            at = batch.schema.get_field_index(name)
            return np.frombuffer(batch.column(at)[i].as_buffer(), kind)
        low, high = raw("low", np.uint16), raw("high", np.uint8)
        names = batch.schema.names
        ids = batch.column(names.index("ids"))[i].as_py() if "ids" in names else []
        yield i, Shard(batch.column(0)[i].as_py(), ids,
                       raw("train", np.uint8).astype(bool), raw("lengths", np.int64),
                       low.astype(np.int64) | (high.astype(np.int64) << 16),
                       raw("words", np.uint64) if "words" in names else None,
                       raw("counts", np.int64) if "counts" in names else None)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, s in _shards(batch):
            n = len(s.words)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(np.full(n, s.number)), "at": pa.array(np.arange(n, dtype=np.int32)),
                "word": pa.array(s.words.view(np.int64)), "n": pa.array(s.counts)})


#: Rows that a task hands to Spark at once.
_SLICE = 1 << 16
#: Counts of several shards that a task sums before it hands them on.
_HELD = 1 << 19
#: Words of which a task chooses the classes at once, and of which a bucket holds about eight times as many.
_CHOSEN = 1 << 12


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every key once, and the sum of its values."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[begins], np.add.reduceat(n[order], begins)


def _slices(**columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_pydict(columns)
    for at in range(0, whole.num_rows, _SLICE):
        yield whole.slice(at, _SLICE)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n): training places of the words, summed over several shards of a task."""
    def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        words, n = _summed(*(np.concatenate(part) for part in zip(*held)))
        return _slices(word=words.view(np.int64), n=n)

    held = []
    for batch in batches:
        words, n = (np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(c)).to_pylist()), kind)
                    for c, kind in (("words", np.uint64), ("counts", np.int64)))
        held.append((words[n > 0], n[n > 0]))
        if sum(len(w) for w, _ in held) >= _HELD:
            yield from summed(held)
            held = []
    if held:
        yield from summed(held)


def _number_of(words: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The place of each word in `known`, or how many those are."""
    order = np.argsort(known)
    at = np.minimum(np.searchsorted(known[order], words), len(known) - 1)
    return np.where(known[order][at] == words, order[at], len(known))


def _bigrams(frequent):
    """(pair, n): training bigrams of the frequent words, all others being one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = frequent.value, 0
        size = len(known) + 1
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for _, s in _shards(batch):
                tokens = _number_of(s.words, known)[s.tokens]
                pairs = s.before(tokens, end) * size + tokens
                total += np.bincount(pairs[s.learned()], minlength=size * size)
        pairs = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(pairs, pa.int64()), "n": pa.array(total[pairs])})
    return run


def _x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def gains(table: np.ndarray, own: np.ndarray, out: np.ndarray, into: np.ndarray, self_pairs: np.ndarray
          ) -> np.ndarray:
    """Of each word alone: the likelihood by class, up to a constant of the word, if the word were in it.

    `own` are the words' classes now; `out` and `into` the classes after and before them, without pairs
    of a word with itself, of which there are `self_pairs`.
    """
    word, diagonal = np.arange(len(own)), np.arange(len(table))
    base = np.repeat(table[None], len(own), 0)
    base[word, own] -= out
    base[word, :, own] -= into
    base[word, own, own] -= self_pairs
    # adding the word to class b changes row b and column b only
    was = _x_log_x(base)
    rows, columns = _x_log_x(base + out[:, None, :]), _x_log_x(base + into[:, :, None])
    corner = base[:, diagonal, diagonal] + out + into + self_pairs[:, None]
    gain = ((rows - was).sum(2) + (columns - was).sum(1) - rows[:, diagonal, diagonal]
            - columns[:, diagonal, diagonal] + was[:, diagonal, diagonal] + _x_log_x(corner))
    left, right = base.sum(2) + into, base.sum(1) + out  # the word's neighbours keep all their places
    outs, ins = (x.sum(1) + self_pairs for x in (out, into))
    return (gain - (_x_log_x(left + outs[:, None]) - _x_log_x(left))
            - (_x_log_x(right + ins[:, None]) - _x_log_x(right)))


def exchange(bigrams: np.ndarray, classes: int, rounds: int = 12) -> np.ndarray:
    """Classes of all words but the last, which stays a class of its own.

    Maximises the sum of n log n over class bigrams less that over the classes on either side.
    """
    words = len(bigrams) - 1
    classes = max(1, min(classes, words))
    own = np.append(np.arange(words) % classes, classes)
    m = bigrams.astype(float)
    k = classes + 1
    table = np.zeros((k, k))
    np.add.at(table, (own[:, None], own[None, :]), m)

    for _ in range(rounds):
        moved = 0
        for w in range(words):
            a = own[w]
            out = np.bincount(own, m[w], minlength=k)
            into = np.bincount(own, m[:, w], minlength=k)
            self_pairs = m[w, w]
            out[a] -= self_pairs
            into[a] -= self_pairs
            gain = gains(table, own[[w]], out[None], into[None], m[w, w][None])[0]
            b = int(np.argmax(gain[:classes]))
            if gain[b] <= gain[a] + 1e-9:
                continue
            for c, sign in ((a, -1), (b, 1)):
                table[c] += sign * out
                table[:, c] += sign * into
                table[c, c] += sign * self_pairs
            own[w], moved = b, moved + 1
        if not moved:
            break
    return own[:words]


class Lookup(NamedTuple):
    """Count and class of a bounded number of words, sorted."""
    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray


def _looked_up(held: Lookup, words: np.ndarray, spare: int) -> tuple[np.ndarray, np.ndarray]:
    if not len(held.words):
        return np.zeros(len(words), np.int64), np.full(len(words), spare)
    at = np.minimum(np.searchsorted(held.words, words), len(held.words) - 1)
    hit = held.words[at] == words
    return np.where(hit, held.counts[at], 0), np.where(hit, held.classes[at], spare).astype(np.int64)


def _known(batch: pa.RecordBatch, i: int, s: Shard, spare: int, lookup) -> tuple[np.ndarray, np.ndarray]:
    """Count and class of each word of the shard's list; `spare` is the class of unseen words.

    They come from the lookup that all tasks have, or else with the shard itself.
    """
    if lookup is not None:
        return _looked_up(lookup.value, s.words, spare)
    words = int(s.tokens.max()) + 1
    counts, classes = np.zeros(words, np.int64), np.full(words, spare)
    rows = batch.column(batch.schema.get_field_index("known"))[i].values
    if rows is not None and len(rows):
        place, n = (rows.field(j).to_numpy() for j in range(2))
        counts[place // _CLASS], classes[place // _CLASS] = n, place % _CLASS
    return counts, classes


def _class_bigrams(size: int, end: int, lookup):
    """(pair, n): training class bigrams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for i, s in _shards(batch):
                _, classes = _known(batch, i, s, size - 1, lookup)
                tokens = classes[s.tokens]
                pairs = s.before(tokens, end) * size + tokens
                total += np.bincount(pairs[s.learned()], minlength=size * size)
        pairs = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(pairs, pa.int64()), "n": pa.array(total[pairs])})
    return run


class Counted(NamedTuple):
    """Counts of words by code: each word once, its class (-1: none), and keys of word's number and code."""
    words: np.ndarray
    own: np.ndarray
    keys: np.ndarray
    n: np.ndarray


def _merged(held: list[Counted], codes: int) -> Counted:
    """Summed over parts in which words have numbers of their own; a word's class is the same in all."""
    words, number = np.unique(np.concatenate([h.words for h in held]), return_inverse=True)
    own = np.empty(len(words), np.int16)
    own[number] = np.concatenate([h.own for h in held])
    first = np.cumsum([0, *(len(h.words) for h in held)])
    keys, n = _summed(np.concatenate([number[at + h.keys // codes] * codes + h.keys % codes
                                      for at, h in zip(first, held)]), np.concatenate([h.n for h in held]))
    return Counted(words, own, keys, n)


#: The counted words of a bucket: words, classes, numbers of codes, and then codes and counts of all of them.
_BLOCK = {"words": np.uint64, "own": np.int16, "sizes": np.uint16, "codes": np.uint16, "counts": np.int64}
_NEAR = "bucket int, code int, n long, " + ", ".join(f"{c} binary" for c in _BLOCK)


def _blocks(c: Counted, codes: int, buckets: int) -> pa.RecordBatch:
    """A row for each bucket of words, by their hash."""
    sizes = np.bincount(c.keys // codes, minlength=len(c.words))
    bucket = (T.mix(c.words) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    order = order[sizes[order] > 0]
    last = np.cumsum(sizes)
    moved = sizes[order]
    place = np.repeat(last[order] - np.cumsum(moved), moved) + np.arange(moved.sum())
    own = (c.words[order], c.own[order], moved, (c.keys % codes)[place], c.n[place])
    begins = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) > 0])[:len(order)])
    of_words = np.append(begins, len(order))
    of_codes = np.concatenate([[0], np.cumsum(moved)])[of_words]
    columns = [pa.array(bucket[order][begins], pa.int32()), pa.nulls(len(begins), pa.int32()),
               pa.nulls(len(begins), pa.int64())]
    for values, kind, at in zip(own, _BLOCK.values(), (of_words,) * 3 + (of_codes,) * 2):
        values = values.astype(kind)
        columns.append(pa.array([values[i:j].tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, ["bucket", "code", "n", *_BLOCK])


def _near(k: int, every: bool, lookup, buckets: int):
    """Blocks of how often a word has a class before it (the code), after it (k + 1 more), or itself.

    Words that the shard was not sent a class of have class k; they are counted only if `every` word is.
    Without a bucket: class bigrams, the code being the pair.
    """
    size = k + 1
    codes = 2 * size + 1

    def packed(held: list[Counted]) -> pa.RecordBatch:
        merged = _merged(held, codes)
        held.clear()
        return _blocks(merged, codes, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size * size, np.int64)
        held = []
        for batch in batches:
            for i, s in _shards(batch):
                n, classes = _known(batch, i, s, k, lookup)
                learned = s.learned()
                ends = np.flatnonzero(s.words == END)[0]
                a, b = s.before(s.tokens, ends)[learned], s.tokens[learned]
                table += np.bincount(classes[a] * size + classes[b], minlength=size * size)
                left, right = (slice(None),) * 2 if every else (n[a] > 0, n[b] > 0)
                same = a[left][a[left] == b[left]]
                keys = np.concatenate([b[right] * codes + classes[a[right]],
                                       a[left] * codes + size + classes[b[left]], same * codes + 2 * size])
                held.append(Counted(s.words, np.where(n > 0, classes, -1).astype(np.int16),
                                    *np.unique(keys, return_counts=True)))
                if sum(len(h.keys) for h in held) >= _HELD:
                    yield packed(held)
        if held:
            yield packed(held)
        at = np.flatnonzero(table)
        none = {c: pa.nulls(len(at), pa.binary()) for c in _BLOCK}
        yield pa.RecordBatch.from_pydict({"bucket": pa.nulls(len(at), pa.int32()), "code": at.astype(np.int32),
                                          "n": table[at], **none})
    return run


def best_classes(table: np.ndarray, own: np.ndarray, exchanged: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The best class of each word by its counts (see `_near`), all others staying as they are.

    Exchanged words go by the likelihood; others by which class explains their neighbours best. The last
    class is that of words without neighbours in other classes.
    """
    k = len(table) - 1
    ahead = table[:k, :k] + 0.5
    ahead = np.log(ahead / ahead.sum(1, keepdims=True) / (ahead.sum(0) / ahead.sum()))
    into, out = seen[:, :k + 1].astype(float), seen[:, k + 1:2 * k + 2].astype(float)
    told = into[:, :k].any(1) | out[:, :k].any(1)
    best = np.where(told, (into[:, :k] @ ahead + out[:, :k] @ ahead.T).argmax(1), own)
    for at in np.array_split(np.flatnonzero(exchanged & told), 1 + exchanged.sum() // 256):
        if len(at):
            a, pairs = own[at], seen[at, -1].astype(float)
            o, i = out[at], into[at]
            o[np.arange(len(at)), a] -= pairs
            i[np.arange(len(at)), a] -= pairs
            gain = gains(table, a, o, i, pairs)
            b = gain[:, :k].argmax(1)
            stay = (a < k) & (gain[np.arange(len(at)), b] <= gain[np.arange(len(at)), a] + 1e-9)
            best[at] = np.where(stay, a, b)
    return best


def _chosen(table):
    """(word, n, class): the best class of the words of whole buckets, and how often training has them."""
    k = len(table.value) - 1
    codes = 2 * k + 3

    def counted(batch: pa.RecordBatch, i: int) -> Counted:
        words, own, sizes, of, n = (
            np.frombuffer(batch.column(batch.schema.get_field_index(c))[i].as_buffer(), kind)
            for c, kind in _BLOCK.items())
        return Counted(words, own, np.repeat(np.arange(len(words)), sizes) * codes + of, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, whole = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                held.append(counted(batch, i))
                if sum(len(h.keys) for h in held) >= 2 * whole + _HELD:
                    held = [_merged(held, codes)]
                    whole = len(held[0].keys)
        if not held:
            return
        c = _merged(held, codes)
        for at in range(0, len(c.words), _CHOSEN):
            words = c.words[at:at + _CHOSEN]
            part = slice(*np.searchsorted(c.keys, [at * codes, (at + len(words)) * codes]))
            seen = np.zeros((len(words), codes), np.int64)
            seen.reshape(-1)[c.keys[part] - at * codes] = c.n[part]
            own = c.own[at:at + _CHOSEN].astype(np.int64)
            best = best_classes(table.value, np.where(own < 0, k, own), own >= 0, seen)
            yield pa.RecordBatch.from_pydict({"word": words.view(np.int64), "n": seen[:, :k + 1].sum(1),
                                              "class": best.astype(np.int32)})
    return run


@dataclass(frozen=True)
class Model:
    transitions: np.ndarray
    """log10 P(class | class before); the last class is that of unseen words."""
    class_tokens: np.ndarray
    class_words: np.ndarray
    tokens: int
    words: int
    end: int

    def scores(self, s: Shard, counts: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each token: log10 probability by the model and by word counts alone."""
        tokens = classes[s.tokens]
        seen = counts > 0
        mass = self.class_tokens[classes] + ADD * self.class_words[classes]
        emit = np.where(seen, np.log10((counts + ADD) / np.where(seen, mass, 1)), 0.0)
        base = np.log10((counts + ADD) / (self.tokens + ADD * (self.words + 1)))
        before = s.before(tokens, self.end)
        return self.transitions[before, tokens] + emit[s.tokens], base[s.tokens]


def transitions(bigrams: np.ndarray, new: float) -> np.ndarray:
    """log10 of the smoothed class transitions; `new` is the share of words that come up first."""
    total = bigrams.sum()
    if not total:
        return np.zeros(bigrams.shape)
    common = bigrams.sum(0) / total
    new = min(max(new, 1e-9), 0.5)
    out = (1 - new) * (bigrams + SMOOTH * common) / (bigrams.sum(1, keepdims=True) + SMOOTH)
    out[:, -1] = new
    return np.log10(np.maximum(out, 1e-300))


def _scored(model, lookup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for i, s in _shards(batch):
                counts, classes = _known(batch, i, s, len(m.transitions) - 1, lookup)
                score, base = m.scores(s, counts, classes)
                starts = s.starts()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(s.ids, pa.int64()), "held_out": pa.array(~s.train),
                    "n_tokens": pa.array(s.lengths),
                    "n_known": pa.array(np.add.reduceat((counts > 0)[s.tokens].astype(np.int64), starts)),
                    "train_tokens": pa.array(np.full(len(s.ids), m.tokens)),
                    "base_score": pa.array(np.add.reduceat(base, starts)),
                    "score": pa.array(np.add.reduceat(score, starts))})
    return run


def _dropped(df: DataFrame) -> None:
    """Delete a stored table that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        drop(df.sparkSession, folder)


@contextmanager
def _small_batches(spark: SparkSession):
    """Few texts, shards or blocks at once in reading, in batches for Python and in pages of written files.

    By default these count rows, thousands or a hundred at least: of shards, all that a task has.
    """
    of = {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
          "spark.sql.parquet.columnarReaderBatchSize": BATCH_ROWS, "parquet.page.size.row.check.min": 1}
    before = {k: spark.conf.get(k, None) for k in of}
    try:
        for k, v in of.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT,
          classes: int = CLASSES, least: int = LEAST, rounds: int = ROUNDS,
          lookup_words: int = LOOKUP_WORDS) -> DataFrame:
    """Per document: `doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`."""
    with _small_batches(docs.sparkSession):
        return written(_scores(docs, doc_id, text, frequent, classes, least, rounds, lookup_words), "scores")


def _scores(docs: DataFrame, doc_id: str, text: str, frequent: int, classes: int, least: int, rounds: int,
            lookup_words: int) -> DataFrame:
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    train = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 10 != 0
    shards = written(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"),
                                 train.alias("train")).mapInArrow(_sharded, _SHARD), "shards")
    rows = shards.mapInArrow(_word_rows, "shard long, at int, word long, n long")
    words = written(shards.select("words", "counts").mapInArrow(_word_counts, "word long, n long")
                    .groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()

    top = (words.filter(F.col("word") != int(END)).orderBy(F.desc("n"), "word")
           .limit(frequent).collect())  # a fixed number of rows
    known = np.array([int(END), *(r.word for r in top)], np.int64).view(np.uint64)
    size = len(known) + 1
    counted = (shards.drop("ids", "counts").mapInArrow(_bigrams(share(known)), "pair long, n long")
               .groupBy("pair").agg(F.sum("n").alias("n")).collect())  # at most size * size
    bigrams = np.zeros(size * size)
    for r in counted:
        bigrams[r.pair] = r.n
    own = exchange(bigrams.reshape(size, size), classes)
    k = int(own.max()) + 1

    fixed = spark.createDataFrame([(int(w), int(c)) for w, c in zip(known.view(np.int64), own)],
                                  "word long, given int")

    def sent(classed: DataFrame, *of: str) -> tuple[DataFrame, object]:
        """The shards, and a lookup of the classed words for all tasks.

        More words than `lookup_words` come with the shards instead: of those that a shard has, place and
        class, n. The shards are then without some columns.
        """
        if classed.count() <= lookup_words:
            held = classed.select("word", "n", "class").toArrow()
            words = held["word"].to_numpy().view(np.uint64)
            order = np.argsort(words)
            return shards.drop("counts"), share(Lookup(words[order], held["n"].to_numpy()[order],
                                        held["class"].to_numpy()[order].astype(np.int16)))
        place = (F.col("at").cast("long") * _CLASS + F.col("class")).alias("place")
        held = (rows.select("shard", "at", "word").join(classed, "word").groupBy(F.col("shard").alias("of"))
                .agg(F.collect_list(F.struct(place, "n")).alias("known")))
        return shards.drop(*of).join(held, F.col("shard") == F.col("of"), "left").drop("of"), None

    classed = written(words.join(F.broadcast(fixed), "word", "left")
                      .filter((F.col("n") >= least) | F.col("given").isNotNull())
                      .select("word", "n", F.coalesce("given", F.lit(k)).alias("class")), "round")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total.v // (8 * _CHOSEN) + 1)
    for r in range(rounds):
        every = r == rounds - 1
        told, lookup = sent(classed.withColumn("n", F.lit(1)), "counts")
        # summed on the map side; words then meet in buckets, each word with a bounded number of codes
        near = written(told.drop("ids").mapInArrow(_near(k, every, lookup, buckets), _NEAR), "near")
        table = np.zeros((k + 1) ** 2)
        for pair in (near.filter("bucket IS NULL").groupBy("code").agg(F.sum("n").alias("n"))
                     .collect()):  # at most that many
            table[pair.code] = pair.n
        before, classed = classed, written(
            near.filter("bucket IS NOT NULL").repartition(buckets, "bucket").mapInArrow(
                _chosen(share(table.reshape(k + 1, k + 1))), "word long, n long, class int"),
            "classed" if every else "round")
        _dropped(near)
        _dropped(before)
    end = classed.filter(F.col("word") == int(END)).first()
    end = end["class"] if end else int(own[0])
    joined, lookup = sent(classed, "words", "counts")

    size = k + 2
    grams = np.zeros(size * size)
    for r in (joined.drop("ids").mapInArrow(_class_bigrams(size, end, lookup), "pair long, n long")
              .groupBy("pair").agg(F.sum("n").alias("n")).collect()):
        grams[r.pair] = r.n
    class_tokens, class_words, once = np.zeros(size), np.zeros(size), 0
    for r in classed.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"),
                                          F.count_if(F.col("n") == 1).alias("once")).collect():
        class_tokens[r["class"]], class_words[r["class"]] = r.n, r.v
        once += r.once
    model = Model(transitions(grams.reshape(size, size), once / max(1, total.n or 0)), class_tokens,
                  class_words, total.n or 0, total.v, end)
    return joined.mapInArrow(_scored(share(model), lookup),
                             "doc_id long, held_out boolean, n_tokens long, n_known long,"
                             " train_tokens long, base_score double, score double")
