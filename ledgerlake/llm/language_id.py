"""Language identification by averaged hashed subword embeddings and a linear softmax.

The subwords of a text are its runs of 2, 3 and 4 bytes (A-Z in lower case), hashed to buckets. A
text is the average of its buckets' embeddings; a linear layer and a softmax give the languages.
Stochastic gradient descent in numpy trains both on a bounded sample of labelled texts. A
temperature fitted on a part of the sample kept back calibrates the scores, and the least score at
which the accepted texts of that part are right often enough is where rejection begins.

For prediction, embeddings times layer is one small table of buckets by languages, so each task
averages rows of that table over whole texts.

Null text, or text without a letter, is `und` with score 0. Without labelled texts all are `und`.
Rows that repeat are predicted one by one. No documents: no rows. Only the named columns are read,
so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import text as T
from ledgerlake.sources.workspace import written

BUCKETS = 1 << 13
SIZES = (2, 3, 4)
UNKNOWN = "und"


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """The bucket of every `size` bytes, wherever they begin."""
    n = max(0, len(data) - size + 1)
    code = np.full(n, size, np.uint64)
    for i in range(size):
        code = (code << np.uint64(8)) | data[i:i + n]
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 13)).astype(np.int64)


def features(text: bytes) -> np.ndarray:
    """The share of each bucket among the subwords of one text."""
    data = T.lower(np.frombuffer(text, np.uint8))
    counts = sum(np.bincount(_grams(data, size), minlength=BUCKETS) for size in SIZES)
    return (counts / max(1, counts.sum())).astype(np.float32)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    table: np.ndarray
    """Logits of each bucket, divided by the temperature."""
    bias: np.ndarray
    least_score: float

    def logits(self, chunk: T.Chunk) -> np.ndarray:
        """Of each text of a chunk: the average of its subwords' rows."""
        data, offsets = T.lower(chunk.data), chunk.offsets
        out = np.zeros((chunk.texts, len(self.languages)))
        count = np.zeros(chunk.texts)
        for size in SIZES:
            grams = _grams(data, size)
            ends = np.maximum(offsets[1:] - size + 1, offsets[:-1])
            count += ends - offsets[:-1]
            for i in range(len(self.languages)):
                sums = np.zeros(len(grams) + 1)
                np.cumsum(self.table[:, i][grams], out=sums[1:])
                out[:, i] += (sums[np.minimum(ends, len(grams))]
                              - sums[np.minimum(offsets[:-1], len(grams))])
        return out / np.maximum(count, 1)[:, None] + self.bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(x: np.ndarray, labels: list[str], width: int = 16, epochs: int = 60, batch: int = 64,
          rate: float = 0.5, right: float = 0.99, seed: int = 1) -> Model:
    """Fit the model to the shares of buckets `x` and their labels. Every fifth row is kept back."""
    languages = sorted(set(labels))
    y = np.array([languages.index(v) for v in labels])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    back, fit = order[::5], order[np.arange(len(y)) % 5 != 0]
    if not len(fit) or len(set(y[fit])) < len(languages):
        fit = back = order
    embed = rng.normal(0, 0.1, (BUCKETS, width)).astype(np.float32)
    layer = rng.normal(0, 0.1, (width, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    scale = np.sqrt(BUCKETS).astype(np.float32)  # shares are small; embeddings learn as if they weren't
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        rng.shuffle(fit)
        for at in range(0, len(fit), batch):
            rows = fit[at:at + batch]
            xs = x[rows] * scale
            hidden = xs @ embed
            slope = _softmax(hidden @ layer + bias)
            slope[np.arange(len(rows)), y[rows]] -= 1
            slope /= len(rows)
            back_hidden = slope @ layer.T
            layer -= step * (hidden.T @ slope)
            bias -= step * slope.sum(0)
            embed -= step * (xs.T @ back_hidden)
    table = scale * embed @ layer
    logits = x[back] @ table + bias
    heats = np.geomspace(0.25, 8, 31)
    losses = [-np.log(_softmax(logits / t)[np.arange(len(back)), y[back]] + 1e-9).mean() for t in heats]
    heat = heats[int(np.argmin(losses))]
    scores = _softmax(logits / heat)
    return Model(languages, table / heat, bias / heat, _least_score(scores, y[back], right))


def _least_score(scores: np.ndarray, y: np.ndarray, right: float) -> float:
    """The least score from which on, counting down, at least a share `right` is right."""
    best = scores.max(1)
    order = np.argsort(-best)
    share = np.cumsum(scores.argmax(1)[order] == y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(share >= right)
    return float(best[order[good[-1]]]) if len(good) else 1.0


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket shares of each whole text, and of a short piece of it, since texts may be short."""
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = text.encode()
            for piece in (raw, raw[:80]):
                share = features(piece)
                at = np.flatnonzero(share)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang], pa.string()),
                    "buckets": pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                    "shares": pa.array([share[at].tobytes()], pa.binary())})


def _predicted(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        names = np.array(m.languages, object)
        for batch in batches:
            for chunk in T.chunks(batch.column(2)):
                scores = _softmax(m.logits(chunk))
                best = scores.argmax(1)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(chunk.first, chunk.texts) for i in (0, 1, 3)),
                     pa.array(names[best], pa.string()), pa.array(scores.max(1), pa.float64())],
                    ["doc_id", "held_out", "letters", "lang", "score"])
    return run


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = 600) -> Model | None:
    """Train on at most `per_language` texts of each language, those with the smallest id hashes.

    Their number is the documented bound of the sample; the sampled texts are used whole.
    """
    named = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    usable = named.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    drawn = F.xxhash64(F.col("id").cast("string"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("drawn", "id"))
    chosen = (usable.select("id", "lang", drawn.alias("drawn")).withColumn("nth", nth)
              .filter(F.col("nth") <= per_language).select("id", F.col("lang").alias("of")).distinct())
    sample = written(usable.join(F.broadcast(written(chosen, "chosen")), "id")
                     .filter(F.col("lang") == F.col("of")).select("lang", "text")
                     .mapInArrow(_featured, "lang string, buckets binary, shares binary"), "features")
    rows = sorted((r.lang, bytes(r.buckets), bytes(r.shares)) for r in sample.collect())
    if not rows:
        return None
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for row, (_, buckets, shares) in zip(x, rows):
        row[np.frombuffer(buckets, np.uint16)] = np.frombuffer(shares, np.float32)
    return train(x, [r[0] for r in rows])


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             per_language: int = 600) -> DataFrame:
    """Per document: `doc_id`, `held_out`, `lang_pred`, `score`, and whether it is `accepted`."""
    model = fit(docs, doc_id, text, lang, per_language)
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"),
                           F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(False).alias("accepted"))
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"),
                       F.col(text).alias("text"), letters.alias("letters"))
    found = rows.mapInArrow(
        _predicted(docs.sparkSession.sparkContext.broadcast(model)),
        f"doc_id {kind}, held_out boolean, letters boolean, lang string, score double")
    return found.select("doc_id", "held_out",
                        F.when(F.col("letters"), F.col("lang")).otherwise(UNKNOWN).alias("lang_pred"),
                        F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"),
                        (F.col("letters") & (F.col("score") >= model.least_score)).alias("accepted"))
