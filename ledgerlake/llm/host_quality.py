"""Quality rules judged by host.

Every document is held against fixed rules. Failures are summed by host (here: the source of a
document), each host's failure rate is shrunk towards the corpus by a beta prior that is fitted to
all hosts by the method of moments, and the verdict on the host is joined back to its documents:

* `rejected` (shrunk rate at least `reject_rate`): none of its documents is kept;
* `suspect` (shrunk rate above `suspect_rate`): its documents must pass every rule;
* `trusted`: its documents must pass the base rules only.

Null text has no words and fails. A null host is a host of its own. Rows that repeat are judged and
counted one by one. No documents: no rows. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerlake.llm import text as T
from ledgerlake.llm.rows import whole_row
from ledgerlake.sources.workspace import written

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = 1


@dataclass(frozen=True)
class Rules:
    least_words: int = 50
    most_repeat_percent: int = 50
    most_symbol_percent: int = 10
    """Symbols for each 100 words."""
    most_dup_lines: int = 10
    least_word_chars: int = 2
    most_word_chars: int = 15
    suspect_rate: float = 0.02
    reject_rate: float = 0.8


def measure(chunk: T.Chunk) -> dict[str, np.ndarray]:
    """The measures of each text of a chunk."""
    data, offsets = chunk.data, chunk.offsets
    found = T.words(chunk, T.SPACED)
    out = {"n_words": np.diff(found.offsets)}
    inside = T.SPACED[data]
    out["word_chars"] = T.per_text(inside & ((data & 0xC0) != 0x80), offsets)
    out["n_symbols"] = T.per_text(_SYMBOLS[data], offsets)
    hashed = T.Hasher(data)
    out["n_dup_lines"] = _repeated_lines(data, offsets, inside, hashed)
    out["n_repeat_words"] = _repeated_words(found, hashed)
    return out


def _repeated_lines(data, offsets, inside, hashed) -> np.ndarray:
    n = len(offsets) - 1
    begins = np.zeros(len(data) + 1, bool)
    begins[1:] = data == 10
    begins[offsets[:-1]] = True
    starts = np.flatnonzero(begins[:-1])
    if not len(starts):
        return np.zeros(n, np.int64)
    ends = np.append(starts[1:], len(data))
    ends = ends - (data[ends - 1] == 10)
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=sums[1:])
    full = sums[ends] > sums[starts]
    starts, ends = starts[full], ends[full]
    text = np.searchsorted(offsets, starts, "right") - 1
    _, firsts = np.unique(T.of_text(hashed(starts, ends), text), return_index=True)
    return np.bincount(text, minlength=n) - np.bincount(text[firsts], minlength=n)


def _repeated_words(found: T.Words, hashed, size: int = 3) -> np.ndarray:
    tokens = hashed(found.starts, found.ends)
    at = T.window_starts(found.offsets, size)
    keys = T.of_text(T.window_hashes(tokens, size)[at], found.text_of()[at])
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = at[counts[which] >= 2]
    hit = np.zeros(len(tokens), bool)
    for i in range(size):
        hit[again + i] = True
    return T.per_text(hit, found.offsets)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in T.chunks(batch.column(batch.schema.get_field_index("__text"))):
            rows = batch.slice(chunk.first, chunk.texts)
            kept = [f.name for f in batch.schema if f.name != "__text"]
            columns = {k: rows.column(batch.schema.get_field_index(k)) for k in kept}
            yield pa.RecordBatch.from_pydict(
                columns | {f"__{k}": pa.array(v, pa.int64()) for k, v in measure(chunk).items()})


def with_measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The `keep` columns and the measures of each text as `__n_words` and so on."""
    schema = StructType([*(StructField(c, docs.schema[c].dataType) for c in keep),
                         *(StructField(f"__{m}", LongType()) for m in MEASURES)])
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(_measured, schema)


def _failures(rules: Rules):
    n, m = F.col("__n_words"), {k: F.col(f"__{k}") for k in MEASURES}
    base = (n < rules.least_words) | (100 * m["n_repeat_words"] > rules.most_repeat_percent * n)
    more = ((100 * m["n_symbols"] > rules.most_symbol_percent * n)
            | (m["n_dup_lines"] > rules.most_dup_lines)
            | (m["word_chars"] < rules.least_word_chars * n)
            | (m["word_chars"] > rules.most_word_chars * n))
    return base, base | more


def host_verdicts(measured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per host (`__host`): documents, failures, shrunk rate and verdict.

    A host with very many documents is summed on the map side, so it costs no task more than others.
    """
    _, failed = _failures(rules)
    hosts = written(
        measured.groupBy("__host").agg(F.count(F.lit(1)).alias("docs"),
                                       F.count_if(failed).alias("failures")), "hosts")
    total = hosts.agg(F.sum("docs").alias("n"), F.sum("failures").alias("f"),
                      F.count(F.lit(1)).alias("h"),
                      F.sum(F.col("failures") * F.col("failures") / F.col("docs")).alias("q")).first()
    a, b = beta_prior(total.n or 0, total.f or 0, total.h, total.q or 0.0)
    rate = (F.col("failures") + F.lit(a)) / (F.col("docs") + F.lit(a + b))
    verdict = (F.when(rate >= rules.reject_rate, "rejected")
               .when(rate > rules.suspect_rate, "suspect").otherwise("trusted"))
    return hosts.select("__host", "docs", "failures", rate.alias("rate"), verdict.alias("__verdict"))


def beta_prior(docs: int, failures: int, hosts: int, squares: float) -> tuple[float, float]:
    """Alpha and beta of the hosts' rates from the sums over hosts of n, f and f * f / n.

    What the rates vary beyond chance is the variance of the prior; where they don't, the prior
    weighs as much as 10,000 documents, and it never weighs less than two.
    """
    if not docs:
        return 1.0, 1.0
    mean = failures / docs
    chance = mean * (1 - mean)
    between = squares / docs - mean * mean - chance * hosts / docs
    weight = min(10_000.0, max(2.0, chance / between - 1)) if between > 0 else 10_000.0
    return mean * weight, (1 - mean) * weight


def _judged(measured: DataFrame, verdicts: DataFrame, rules: Rules) -> DataFrame:
    base, failed = _failures(rules)
    hosts = verdicts.select(F.col("__host").alias("__h"), "__verdict")
    kept = (F.when(base, False).when(F.col("__verdict") == "rejected", False)
            .when(F.col("__verdict") == "suspect", ~failed).otherwise(True))
    return (measured.join(hosts, F.col("__host").eqNullSafe(F.col("__h")), "left")
            .withColumns({"__base_failed": base, "__kept": kept}))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
          rules: Rules = Rules()) -> DataFrame:
    """Per document: its measures, `base_failed`, `kept` and the verdict on its host."""
    named = docs.select(F.col(doc_id).alias("__id"), F.col(host).alias("__host"),
                        F.col(text).alias("__t"))
    measured = written(with_measures(named, "__t", ("__id", "__host")), "measures")
    out = _judged(measured, host_verdicts(measured, rules), rules)
    return out.select(F.col("__id").alias("doc_id"), *(F.col(f"__{m}").alias(m) for m in MEASURES),
                      F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"),
                      F.col("__verdict").alias("host_verdict"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source",
              rules: Rules = Rules()) -> DataFrame:
    """The documents kept, with all their columns.

    The texts are measured twice, once for the hosts and once on the way through, which is less
    work than sending them through a join on their ids.
    """
    flat = docs.select(whole_row(docs).alias("__row"), F.col(host).alias("__host"),
                       F.col(text).alias("__t"))
    measured = with_measures(flat.drop("__row"), "__t", ("__host",))
    verdicts = host_verdicts(measured, rules)
    all_rows = with_measures(flat, "__t", ("__row", "__host"))
    return _judged(all_rows, verdicts, rules).filter("__kept").select("__row.*")
