"""A quality classifier by perplexity under trusted text.

An interpolated modified Kneser-Ney trigram model (Chen and Goodman) is trained on all trusted texts but
a fifth, which is never trained on. A document is kept if its perplexity is at most the threshold of its
language: a high quantile of the perplexities of the trusted documents of that language that were not
trained on, over all of them. A language with fewer than `least_trusted` of these takes the threshold
over all languages.

Texts of a few MB to train on give count tables that are sent to all tasks. With more,
1. the words of training are counted and numbered, common ones first; the numbers go to all tasks;
2. every token is a triple of words (u, v, w). Tasks pack triples in blocks by a bucket of v; all that a
   probability needs but the counts of single words meets there: the counts of u v w, u v, v w and v.
   Words too frequent for one bucket are dealt out by u; only the counts of v w are then summed
   over buckets and sent back. Triples of trained texts give the counts of counts and those of words;
3. triples of all documents meet those of trained texts in the same buckets, in slices of documents. A
   bucket counts, and returns the sum of logarithms of each document. No count is stored or leaves its bucket.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z in lower case; a text begins after two begin marks and ends
with an end, which counts as a token. Null text is empty. A null language is a language of its own.
Without trusted texts everything is kept. Rows that repeat are judged one by one. No documents: no
rows. Only the named columns are read, so others cannot clash. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import text as T
from ledgerlake.sources.workspace import written

BEGIN, END = np.uint64(1), np.uint64(2)
SHARDS = 16
#: Bytes of trained text whose count tables are sent to all tasks; more are counted in buckets.
SENT_BYTES = 4 << 20
#: Ids of trusted texts that are sent to all tasks; more are joined by a shuffle.
SENT_IDS = 4_000_000
#: Bytes of text for each bucket of words.
BUCKET_BYTES = 8 << 20
#: Tokens that a task packs in blocks at once.
BLOCK_TOKENS = 1 << 20
#: Slices of documents that are scored one after the other, so that less is shuffled at a time.
SLICES = 2


def _join(*tokens: np.ndarray) -> np.ndarray:
    out = np.zeros(len(tokens[0]), np.uint64)
    for t in tokens:
        out = T.mix(out * np.uint64(0x9E3779B97F4A7C15) + t)
    return out


def tokens_of(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of each text with two begins before and an end behind, and where texts begin."""
    data = T.lower(chunk.data)
    found = T.words(T.Chunk(chunk.first, data, chunk.offsets), T.SPACED)
    at = np.concatenate([np.repeat(found.offsets[:-1], 2), found.offsets[1:]])
    marks = np.repeat(np.array([BEGIN, END]), [2 * chunk.texts, chunk.texts])
    # at one place the end of a text comes before the begins of the next
    order = np.lexsort((np.repeat([1, 0], [2 * chunk.texts, chunk.texts]), at))
    empty = np.diff(found.offsets) == 0
    if empty.any():
        order = np.lexsort((_ranks(chunk.texts), at))
    tokens = np.insert(T.Hasher(data)(found.starts, found.ends), at[order], marks[order])
    return tokens, found.offsets + 3 * np.arange(chunk.texts + 1)


def _ranks(n: int) -> np.ndarray:
    """An order of marks that share a place: text by text, begins before the end."""
    return np.concatenate([np.repeat(np.arange(n) * 3, 2), np.arange(n) * 3 + 1])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, before, pair, middle, word) of each token: keys of u v w, u v, v w, v and w."""
    for batch in batches:
        for chunk in T.chunks(batch.column(0)):
            tokens, offsets = tokens_of(chunk)
            w = _predicted(offsets)
            u, v, word = tokens[w - 2], tokens[w - 1], tokens[w]
            keys = {"gram": _join(u, v, word), "before": _join(u, v), "pair": _join(v, word),
                    "middle": v, "word": word}
            yield pa.RecordBatch.from_pydict({k: pa.array(x.view(np.int64)) for k, x in keys.items()})


def _predicted(offsets: np.ndarray) -> np.ndarray:
    """All tokens but the begins."""
    inside = np.ones(offsets[-1], bool)
    inside[offsets[:-1]] = inside[offsets[:-1] + 1] = False
    return np.flatnonzero(inside)


class Table:
    """Rows of numbers by 64-bit key, in shards by the key's last bits."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        keys = keys.astype(np.int64).view(np.uint64)
        self.shards = []
        for s in range(SHARDS):
            own = np.flatnonzero(keys % np.uint64(SHARDS) == s)
            own = own[np.argsort(keys[own])]
            self.shards.append((keys[own], [np.asarray(v, np.float32)[own] for v in values]))
        self.width = len(values)

    def __call__(self, keys: np.ndarray) -> list[np.ndarray]:
        """The numbers of each key; zeros where it is not there."""
        out = [np.zeros(len(keys), np.float32) for _ in range(self.width)]
        shard = keys % np.uint64(SHARDS)
        for s, (known, values) in enumerate(self.shards):
            mine = np.flatnonzero(shard == s)
            if not len(known) or not len(mine):
                continue
            at = np.minimum(np.searchsorted(known, keys[mine]), len(known) - 1)
            hit = known[at] == keys[mine]
            for column, value in zip(out, values):
                column[mine[hit]] = value[at[hit]]
        return out


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What is taken off counts of 1, 2 and more: some of each, so that nothing has no probability.

    Half where the counts of counts don't tell.
    """
    if not (n1 and n2 and n3):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(off, 0.05), 0.95 * k) for k, off in (
        (1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))


def smoothed(count: np.ndarray, context, off: tuple[float, float, float], lower: np.ndarray) -> np.ndarray:
    """The probability by counts after a context (see `Level.contexts`) and the next lower order."""
    total, one, two, more = context
    less = np.select([count == 0, count < 2, count < 3], [0.0, off[0], off[1]], off[2])
    left = off[0] * one + off[1] * two + off[2] * more
    seen = total > 0
    by = np.where(seen, total, 1)
    return np.where(seen, np.maximum(count - less, 0) / by + left / by * lower, lower)


@dataclass
class Level:
    counts: Table
    contexts: Table
    """Sum of the counts after a context, and how many words have 1, 2 and more."""
    off: tuple[float, float, float]

    def __call__(self, keys: np.ndarray, contexts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        (count,) = self.counts(keys)
        return smoothed(count, self.contexts(contexts), self.off, lower)


@dataclass
class Model:
    three: Level
    two: Level
    one: Level
    words: int

    def log10(self, tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of each token but the begins."""
        at = _predicted(offsets)
        u, v, w = tokens[at - 2], tokens[at - 1], tokens[at]
        p = np.full(len(at), 1.0 / (self.words + 1))
        p = self.one(w, np.zeros(len(at), np.uint64), p)
        p = self.two(_join(v, w), v, p)
        p = self.three(_join(u, v, w), _join(u, v), p)
        return np.log10(p)


def _level(rows: DataFrame, key: str, context: str | None) -> Level:
    """From (key, context, n) rows, each key once."""
    kinds = [F.count_if(F.col("n") == i) for i in (1, 2, 3, 4)]
    counts = rows.agg(*(k.alias(f"n{i}") for i, k in enumerate(kinds, 1))).first()
    by = (rows if context else rows.withColumn("all", F.lit(0).cast("long"))).groupBy(context or "all")
    contexts = by.agg(F.sum("n").alias("total"), kinds[0].alias("one"), kinds[1].alias("two"),
                      F.count_if(F.col("n") >= 3).alias("more")).toArrow()
    own = rows.select(key, "n").toArrow()
    return Level(Table(own[key].to_numpy(), own["n"].to_numpy()),
                 Table(contexts[context or "all"].to_numpy(),
                       *(contexts[c].to_numpy() for c in ("total", "one", "two", "more"))),
                 discounts(*counts))


def train(texts: DataFrame, text: str = "text") -> Model | None:
    """The model of a bounded frame of texts. Lower orders count distinct contexts, not occurrences."""
    grams = written(texts.select(text).mapInArrow(
        _grams, "gram long, before long, pair long, middle long, word long")
        .groupBy("gram", "before", "pair", "middle", "word").agg(F.count(F.lit(1)).alias("n")), "grams")
    pairs = written(grams.groupBy("pair", "middle", "word").agg(F.count(F.lit(1)).alias("n")), "pairs")
    words = written(pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")
    n = words.count()
    if not n:
        return None
    return Model(_level(grams, "gram", "before"), _level(pairs, "pair", "middle"),
                 _level(words, "word", None), n)


def _perplexed(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for chunk in T.chunks(batch.column(2)):
                tokens, offsets = tokens_of(chunk)
                logs = np.concatenate([[0.0], np.cumsum(m.log10(tokens, offsets))])
                ends = offsets - 2 * np.arange(len(offsets))
                n = np.diff(ends)
                own = (batch.column(i).slice(chunk.first, chunk.texts) for i in (0, 1, 3))
                yield pa.RecordBatch.from_arrays([*own, pa.array(n), pa.array(logs[ends[1:]] - logs[ends[:-1]])],
                                                 ["doc_id", "lang", "trained", "n_tokens", "log10_prob"])
    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n): counts of the words and ends of a few chunks."""
    held, n = [], 0

    def counted() -> pa.RecordBatch:
        words, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_pydict({"word": words.view(np.int64), "n": counts})
    for batch in batches:
        for chunk in T.chunks(batch.column(0)):
            tokens, offsets = tokens_of(chunk)
            held.append(tokens[_predicted(offsets)])
            n += len(held[-1])
            if n >= BLOCK_TOKENS:
                yield counted()
                held, n = [], 0
    if held:
        yield counted()


class Numbers(NamedTuple):
    """The words of training, sorted, and their numbers: 0 is any other word, 1 the begin, 2 the most frequent."""
    words: np.ndarray
    numbers: np.ndarray

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
        return np.where(self.words[at] == tokens, self.numbers[at], 0)


class Buckets(NamedTuple):
    """Where triples go: `plain` buckets by v; a frequent v has buckets of its own, by u."""
    plain: int
    first: np.ndarray
    """By number of the most frequent words: their first bucket, or -1."""
    parts: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, plain: int) -> Buckets:
        """For counts by number, falling. A word of more than two buckets' share is dealt out."""
        parts = np.ceil(counts * plain / max(1, counts.sum())).astype(np.int64)
        parts = parts[:np.flatnonzero(parts > 2).max(initial=-1) + 1]
        own = np.where(parts > 2, parts, 0)
        return cls(plain, np.where(own > 0, plain + np.cumsum(own) - own, -1), own)

    @property
    def total(self) -> int:
        return self.plain + int(self.parts.sum())

    def dealt(self, v: np.ndarray) -> np.ndarray:
        """Which words are dealt out."""
        if not len(self.first):
            return np.zeros(len(v), bool)
        return (v < len(self.first)) & (self.first[np.minimum(v, len(self.first) - 1)] >= 0)

    def __call__(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        out = (T.mix(v.astype(np.uint64)) % np.uint64(self.plain)).astype(np.int64)
        at = np.flatnonzero(self.dealt(v))
        part = T.mix(u[at].astype(np.uint64) + np.uint64(1 << 40)) % self.parts[v[at]].astype(np.uint64)
        out[at] = self.first[v[at]] + part.astype(np.int64)
        return out


def _packed(values: np.ndarray) -> bytes:
    """Numbers below 2^32, byte by byte of all, compressed, behind their count."""
    values = values.astype("<u4")
    planes = values.view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.decompress(raw[8:], 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4")[:, 0].astype(np.int64)


#: Triples of a shard's texts in one bucket, v as steps; `text` is 0 for texts that are not scored, and else
#: twice the text's number and 2 more; for trained texts it is 1 more. Or counts of v w, in `text`, without a shard.
#: Or the texts of a shard, without triples; `own` sums what needs no bucket.
_TEXTS = "ids array<long>, langs array<{kind}>, trained array<boolean>, n_tokens array<long>, own array<double>"
_BLOCK = "bucket int, shard long, u binary, v binary, w binary, text binary, " + _TEXTS


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _batch(names: list[str], rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], schema.field(c).type) for c in names],
                                      names)


def _block_schema(lang: pa.DataType) -> pa.Schema:
    return pa.schema([("bucket", pa.int32()), ("shard", pa.int64()),
                      *((c, pa.binary()) for c in ("u", "v", "w", "text")),
                      ("ids", pa.list_(pa.int64())), ("langs", pa.list_(lang)), ("trained", pa.list_(pa.bool_())),
                      ("n_tokens", pa.list_(pa.int64())), ("own", pa.list_(pa.float64()))])


def _blocks(numbers, buckets: Buckets, logs=None):
    """Rows of `_BLOCK` from (text, id, lang, trained, scored). Without `logs` only triples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, texts, scored = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for chunk in T.chunks(batch.column(0)):
                tokens, offsets = tokens_of(chunk)
                at = _predicted(offsets)
                known = numbers.value(tokens)
                u, v, w = known[at - 2], known[at - 1], known[at]
                own = batch.slice(chunk.first, chunk.texts)
                trained, wanted = (own.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
                place = np.where(wanted, scored + np.cumsum(wanted) - 1, -1)
                n = np.diff(offsets) - 2
                text = np.repeat(np.where(wanted, 2 * place + 2, 0) + trained, n)
                if logs is not None:
                    # after a word that training never saw, only the word itself tells
                    alone = np.repeat(np.arange(chunk.texts), n)[v == 0]
                    sums = np.bincount(alone, logs.value[w[v == 0]], minlength=chunk.texts)
                    texts.append((own.filter(pa.array(wanted)), n[wanted], sums[wanted]))
                    scored += int(wanted.sum())
                sent = (v > 0) & (np.repeat(wanted | trained, n))
                held.append([x[sent].astype(np.int32) for x in (u, v, w, text)])
                if sum(len(h[0]) for h in held) >= BLOCK_TOKENS or scored >= BLOCK_TOKENS:
                    yield pack(batch, shard, held, texts)
                    shard, held, texts, scored = shard + 1, [], [], 0
        if held:
            yield pack(batch, shard, held, texts)

    def pack(batch: pa.RecordBatch, shard: int, held: list, texts: list) -> pa.RecordBatch:
        u, v, w, text = (np.concatenate(x).astype(np.int64) for x in zip(*held))
        bucket = buckets(u, v)
        order = np.argsort((bucket << 44) | ((v & 0x3fffff) << 22) | (u & 0x3fffff))
        bucket, u, v, w, text = (x[order] for x in (bucket, u, v, w, text))
        begins = np.flatnonzero(np.diff(bucket, prepend=-1))
        rows = []
        for i, j in zip(begins, np.append(begins[1:], len(u))):
            rows.append({"bucket": int(bucket[i]), "shard": shard, "u": _packed(u[i:j]), "w": _packed(w[i:j]),
                         "v": _packed(np.diff(v[i:j], prepend=0)), "text": _packed(text[i:j])})
        if texts:
            whole = pa.Table.from_batches([t[0] for t in texts])
            rows.append({"bucket": int(T.mix(np.array([shard], np.uint64))[0] % np.uint64(buckets.total)),
                         "shard": shard, **{c: whole.column(i).to_pylist() for c, i in
                                            (("ids", 1), ("langs", 2), ("trained", 3))},
                         "n_tokens": np.concatenate([t[1] for t in texts]),
                         "own": np.concatenate([t[2] for t in texts])})
        schema = _block_schema(batch.schema.field(2).type)
        return _batch(schema.names, rows, schema)
    return run


def _triples(batch: pa.RecordBatch, i: int) -> list[np.ndarray]:
    u, v, w, text = (_unpacked(batch.column(batch.schema.get_field_index(c))[i].as_py())
                     for c in ("u", "v", "w", "text"))
    return [u, np.cumsum(v) & 0xffffffff, w, text]


_LOW = 0xffffffff


class Counted(NamedTuple):
    """Distinct triples of some tokens and their pairs v w, with counts over the trained tokens."""
    of: np.ndarray
    """The triple of each token."""
    n: np.ndarray
    context: np.ndarray
    """The number of u v, of each triple."""
    pairs: np.ndarray
    """v and w, in 32 bits each."""
    pair: np.ndarray
    """Of each triple."""
    before: np.ndarray
    """Of each pair, the number of different words before it."""


def _counted(u: np.ndarray, v: np.ndarray, w: np.ndarray, trained: np.ndarray) -> Counted:
    contexts, context = np.unique(v << 32 | u, return_inverse=True)
    triples, of = np.unique(context << 32 | w, return_inverse=True)
    n = np.bincount(of, trained, minlength=len(triples))
    context = triples >> 32
    pairs, pair = np.unique((contexts[context] >> 32 << 32) | (triples & _LOW), return_inverse=True)
    return Counted(of, n, context, pairs, pair, np.bincount(pair, n > 0, minlength=len(pairs)))


def _contexts(of: np.ndarray, n: np.ndarray, size: int) -> list[np.ndarray]:
    """Sums of the counts after each context, and how many are 1, 2 and more."""
    return [np.bincount(of, x, minlength=size) for x in (n, n == 1, n == 2, n >= 3)]


def _counts_of_counts(buckets: Buckets):
    """(kind, a, b, n): 3 and 2: triples and pairs that are there `a` times; 1: different words before `a`;
    0: of pairs a b of dealt words, the different words before them in this bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_triples(b, i) for b in batches for i in range(b.num_rows)]
        if not held:
            return
        u, v, w, _ = (np.concatenate(x) for x in zip(*held))
        held.clear()
        c = _counted(u, v, w, np.ones(len(u)))
        v, w = c.pairs >> 32, c.pairs & _LOW
        dealt = buckets.dealt(v)
        for kind, n in ((3, c.n), (2, c.before[~dealt])):
            times = np.bincount(n[n <= 4].astype(np.int64), minlength=5)[1:]
            yield from rows(kind, np.arange(1, 5), np.zeros(4), times)
        words, n = np.unique(w[~dealt], return_counts=True)
        yield from rows(1, words, np.zeros(len(words)), n)
        yield from rows(0, v[dealt], w[dealt], c.before[dealt])

    def rows(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        whole = pa.RecordBatch.from_pydict({"kind": np.full(len(a), kind, np.int32), "a": a.astype(np.int32),
                                            "b": b.astype(np.int32), "n": n.astype(np.int64)})
        for at in range(0, len(a), 1 << 16):
            yield whole.slice(at, 1 << 16)
    return run


def _dealt_counts(buckets: Buckets, lang: pa.DataType):
    """Rows of `_BLOCK` with the counts of pairs (a, b, n) for each bucket of a dealt word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _block_schema(lang)
        for batch in batches:
            a, b, n = (batch.column(i).to_numpy().astype(np.int64) for i in range(3))
            for word in np.unique(a):
                mine = a == word
                row = {"v": _packed(a[mine]), "w": _packed(b[mine]), "text": _packed(n[mine])}
                yield _batch(schema.names, [row | {"bucket": int(buckets.first[word]) + p}
                                            for p in range(buckets.parts[word])], schema)
    return run


class Orders(NamedTuple):
    """What all buckets know: discounts of triples and pairs, and the probability of words alone, by number."""
    three: tuple[float, float, float]
    two: tuple[float, float, float]
    words: np.ndarray


def _log10(orders: Orders, u: np.ndarray, v: np.ndarray, w: np.ndarray, trained: np.ndarray,
           known: list[np.ndarray]) -> np.ndarray:
    """Of each token; `known` are the pairs (v, w, n) of dealt words."""
    c = _counted(u, v, w, trained)
    before, of = c.before, c.pairs >> 32
    summed, n = of, before
    if known is not None:
        dealt, first = np.unique(known[0] << 32 | known[1], return_index=True)
        n_dealt = known[2][first]
        at = np.minimum(np.searchsorted(dealt, c.pairs), len(dealt) - 1)
        before = np.where(dealt[at] == c.pairs, n_dealt[at], before)
        other = ~np.isin(of, dealt >> 32)
        summed, n = np.concatenate([of[other], dealt >> 32]), np.concatenate([before[other], n_dealt])
    middles, middle = np.unique(np.concatenate([of, summed]), return_inverse=True)
    after = _contexts(middle[len(of):], n, len(middles))
    p = smoothed(before, [x[middle[:len(of)]] for x in after], orders.two, orders.words[c.pairs & _LOW])
    after = _contexts(c.context, c.n, int(c.context.max()) + 1)
    return np.log10(smoothed(c.n, [x[c.context] for x in after], orders.three, p[c.pair]))[c.of]


def _sums(orders):
    """From whole buckets: the sums of each shard's texts, and its texts as they came."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known, schema = [], [], None
        for batch in batches:
            names = [c for c in batch.schema.names if c not in ("u", "v", "w", "text")]
            schema = pa.schema([*(batch.schema.field(c) for c in names), ("at", pa.binary()), ("sums", pa.binary())])
            for i in range(batch.num_rows):
                get = {c: batch.column(batch.schema.get_field_index(c))[i] for c in (*names, "u", "w")}
                if get["ids"].is_valid:
                    yield _batch(schema.names, [{c: get[c].as_py() for c in names} | {"bucket": -1}], schema)
                elif get["u"].is_valid:
                    held.append((get["shard"].as_py(), get["bucket"].as_py(), _triples(batch, i)))
                else:
                    known.append([_unpacked(batch.column(batch.schema.get_field_index(c))[i].as_py())
                                  for c in ("v", "w", "text")])
        if not held:
            return
        held.sort(key=lambda h: h[:2])
        sizes = [len(h[2][0]) for h in held]
        u, v, w, text = (np.concatenate(x) for x in zip(*(h[2] for h in held)))
        shards = [h[:2] for h in held]
        held.clear()
        logs = _log10(orders.value, u, v, w, text % 2 == 1,
                      [np.concatenate(x) for x in zip(*known)] if known else None)
        ends = np.cumsum(sizes)
        for (shard, bucket), i, j in zip(shards, ends - sizes, ends):
            sums = np.bincount(text[i:j] // 2, logs[i:j])
            at = 1 + np.flatnonzero(sums[1:])
            yield _batch(schema.names, [{"shard": shard, "bucket": bucket, "at": _packed(at - 1),
                                         "sums": sums[at].astype("<f4").tobytes()}], schema)
    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each shard's texts come first, then their sums by bucket."""
    texts, total = None, None

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*texts, pa.array(total)],
                                          ["doc_id", "lang", "trained", "n_tokens", "log10_prob"])
    for batch in batches:
        get = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
        for i in range(batch.num_rows):
            if get["ids"][i].is_valid:
                if texts is not None:
                    yield rows()
                texts = [get[c][i].values for c in ("ids", "langs", "trained", "n_tokens")]
                total = np.array(get["own"][i].values.to_numpy())
            else:
                at = _unpacked(get["at"][i].as_py())
                total[at] += np.frombuffer(get["sums"][i].as_py(), "<f4")
    if texts is not None:
        yield rows()


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Written, and what it shuffled deleted at once: nothing reads it again."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = conf.get(name)
    conf.set(name, "true")
    try:
        return written(df, label)
    finally:
        conf.set(name, was)


def _bucketed(named: DataFrame, slices: int) -> DataFrame | None:
    """(doc_id, lang, trained, n_tokens, log10_prob) of all documents, or none without training."""
    spark = named.sparkSession
    share = spark.sparkContext.broadcast
    kind = named.schema["lang"].dataType.simpleString()
    trained = named.filter("trained")
    words = _stored(trained.select("text").mapInArrow(_words, "word long, n long")
                    .groupBy("word").agg(F.sum("n").alias("n")), "words").toArrow()
    if not words.num_rows:
        return None
    # 12 bytes a word of training go to all tasks, and 16 through the driver
    word, n = words["word"].to_numpy().view(np.uint64), words["n"].to_numpy()
    order = np.lexsort((word, -n))
    known = np.concatenate([[BEGIN], word[order]])
    texts = int(n[word == END].sum())
    by_word = np.argsort(known)
    numbers = share(Numbers(known[by_word], (by_word + 1).astype(np.int32)))
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # an end stands before nothing; every text has two begins, of which v is the second once
    times = np.concatenate([[0, texts], np.where(word[order] == END, 0, n[order])])
    times[1] = 0  # a text's first triple has one u only, so that it cannot be dealt out
    buckets = Buckets.of(times, max(spark.sparkContext.defaultParallelism, size // BUCKET_BYTES + 1))

    texts_of = named.select("text", "id", "lang", "trained")
    blocks = _BLOCK.format(kind=kind)
    counts = _stored(
        texts_of.filter("trained").withColumn("scored", F.lit(False))
        .mapInArrow(_blocks(numbers, buckets), blocks).select("bucket", "u", "v", "w", "text")
        .repartitionById(buckets.total, F.col("bucket"))
        .mapInArrow(_counts_of_counts(buckets), "kind int, a int, b int, n long")
        .groupBy("kind", "a", "b").agg(F.sum("n").alias("n")), "counts")
    dealt = counts.filter("kind = 0")
    times = {3: [0] * 4, 2: [0] * 4}
    for r in counts.filter("kind >= 2").collect():  # four each
        times[r.kind][r.a - 1] += r.n
    for r in dealt.filter("n <= 4").groupBy("n").count().collect():
        times[2][r.n - 1] += r["count"]
    before = np.zeros(len(known) + 1)
    for of in (counts.filter("kind = 1").select(F.col("a").alias("w"), "n"),
               dealt.groupBy(F.col("b").alias("w")).agg(F.count(F.lit(1)).alias("n"))):
        rows = of.toArrow()  # a row a word
        before[rows["w"].to_numpy()] += rows["n"].to_numpy()
    off = discounts(*(int((before == i).sum()) for i in (1, 2, 3, 4)))
    alone = smoothed(before, [x[0] for x in _contexts(np.zeros(len(before), np.int64), before, 1)], off,
                     np.full(len(before), 1.0 / (len(word) + 1)))
    orders = share(Orders(discounts(*times[3]), discounts(*times[2]), alone))
    logs = share(np.log10(alone))

    out = None
    lang = texts_of.select("lang").limit(0).toArrow().schema.field(0).type
    pairs = dealt.select("a", "b", "n").mapInArrow(_dealt_counts(buckets, lang), blocks)
    for i in range(slices):
        scored = F.pmod(F.xxhash64("id", "text"), F.lit(slices)) == i
        triples = texts_of.withColumn("scored", scored).filter("scored OR trained").mapInArrow(
            _blocks(numbers, buckets, logs), blocks)
        sums = triples.unionByName(pairs).repartitionById(buckets.total, F.col("bucket")).mapInArrow(
            _sums(orders), f"bucket int, shard long, {_TEXTS.format(kind=kind)}, at binary, sums binary")
        rows = _stored(sums.repartition("shard").sortWithinPartitions("shard", "bucket").mapInArrow(
            _totals, f"doc_id long, lang {kind}, trained boolean, n_tokens long, log10_prob double"), "slice")
        out = rows if out is None else out.unionByName(rows)
    return out


def classify(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang", per_language: int | None = None, quantile: float = 0.995,
             least_trusted: int = 30, sent_bytes: int = SENT_BYTES, slices: int = SLICES) -> DataFrame:
    """Per document: `doc_id`, `lang`, `n_tokens`, `log10_prob`, `perplexity`, `threshold`, `kept`.

    `trusted` holds the ids of trusted documents in its first column. All of them are used; a caller may
    have at most `per_language` texts of each language trained on. Up to `sent_bytes` of text to train on
    are counted in tables for all tasks.
    """
    ids = written(trusted.select(F.col(trusted.columns[0]).cast("long").alias("t")).filter("t IS NOT NULL")
                  .distinct(), "trusted")
    sent = ids.count() <= SENT_IDS
    ids = F.broadcast(ids) if sent else ids
    named = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(lang).alias("lang"),
                        F.col(text).alias("text"))
    # a fifth of the trusted texts is never trained on, so that a small corpus has a threshold too
    learned = F.pmod(F.xxhash64("id"), F.lit(5)) != 0
    named = named.join(ids, F.col("id") == F.col("t"), "left").withColumn("trusted", F.col("t").isNotNull()).drop("t")
    if per_language is None:
        named = named.withColumn("trained", F.col("trusted") & learned)
    else:
        nth = F.row_number().over(Window.partitionBy("lang").orderBy("drawn", "id"))
        chosen = written(named.filter(F.col("trusted") & learned).select("id", "lang")
                         .withColumn("drawn", F.xxhash64(F.col("id").cast("string"))).withColumn("nth", nth)
                         .filter(F.col("nth") <= per_language).select(F.col("id").alias("c")).distinct(), "chosen")
        named = named.join(chosen, F.col("id") == F.col("c"), "left").withColumn("trained", F.col("c").isNotNull())
    named = named.select("id", "lang", "text", F.coalesce("trained", F.lit(False)).alias("trained"))
    named = named if sent and per_language is None else written(named, "flagged")  # joined once only
    texts = named.filter("trained").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0]
    if texts is not None and texts <= sent_bytes:
        model = train(named.filter("trained"))
        scored = named.select("id", "lang", "text", "trained").mapInArrow(
            _perplexed(docs.sparkSession.sparkContext.broadcast(model)),
            f"doc_id long, lang {docs.schema[lang].dataType.simpleString()}, trained boolean, n_tokens long,"
            " log10_prob double")
    else:
        scored = None if texts is None else _bucketed(named, slices)
    if scored is None:
        none = F.lit(None).cast("double")
        return named.select(F.col("id").alias("doc_id"), "lang", F.lit(0).cast("long").alias("n_tokens"),
                            none.alias("log10_prob"), none.alias("perplexity"), none.alias("threshold"),
                            F.lit(True).alias("kept"))
    scored = written(scored.withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_tokens"))), "perplexities")

    fresh = scored.filter("not trained").join(ids, F.col("doc_id") == F.col("t"))
    high = F.percentile_approx("perplexity", quantile, 10_000).alias("high")
    own = fresh.groupBy("lang").agg(high, F.count(F.lit(1)).alias("n"))
    own = own.filter(F.col("n") >= least_trusted).select(F.col("lang").alias("l"), "high")
    overall = fresh.agg(high).first().high
    overall = float("inf") if overall is None else overall
    return (scored.join(written(own, "thresholds"), F.col("lang").eqNullSafe(F.col("l")), "left")
            .withColumn("threshold", F.coalesce("high", F.lit(overall)))
            .select("doc_id", "lang", "n_tokens", "log10_prob", "perplexity", "threshold",
                    (F.col("perplexity") <= F.col("threshold")).alias("kept")))
