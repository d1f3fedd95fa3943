"""Mixing sources to target weights by weighted sampling without replacement.

Each document draws an exponential key with its quality weight as the rate (Efraimidis and
Spirakis): in ascending order of the keys, every prefix is a weighted sample. A source's target is
met by complete epochs of the source and then by the prefix of its documents, in key order, whose
sizes sum up to what is left. The document at the cut gives its leading words only.

A source may hold a third of all rows, so no task orders a whole source: keys are cut into bins of
a few thousand documents, bins are summed first, and the prefix sum inside a bin starts from the
sum of the bins before it.

Null text has size 0 and takes nothing. A null source is a source of its own and comes last. Keys
come from a hash of id, text and seed; equal rows have equal keys and any order among them gives the
same rows. No documents: no rows. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.rows import whole_row
from ledgerlake.sources.workspace import written

WORDS = r"[^\x20\x09-\x0D]+"
_BITS = 2.0**48


def quality_weight(text: Column, size: Column) -> Column:
    """1 for prose, less for texts with many symbols for their words."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.when(size > 0, size / (size + symbols)).otherwise(F.lit(1.0))


def _sized(docs: DataFrame, doc_id: str, text: str, source: str, seed: int) -> DataFrame:
    drawn = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)),
                                                 F.coalesce(F.col("__id").cast("string"), F.lit("")),
                                                 F.md5("__t"))), 1, 12), 16, 10)
    return (docs.select(F.col(doc_id).alias("__id"), F.col(source).alias("__source"),
                        F.coalesce(F.col(text), F.lit("")).alias("__t"))
            .select("__id", "__source", F.md5("__t").alias("__hash"),
                    F.regexp_count("__t", F.lit(WORDS)).cast("long").alias("__size"),
                    ((drawn.cast("double") + 0.5) / _BITS).alias("__u"), "__t")
            .withColumn("__key", -F.log("__u") / quality_weight(F.col("__t"), F.col("__size")))
            .select("__id", "__source", "__hash", "__size", "__key"))


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """`__target` of each source (`__source`, `__total`): water filling under the sources' caps.

    A source whose cap over weight is below the level is full; the level is what is left for the
    others over their weights. Ordering by cap over weight finds it in one pass over the sources.
    """
    by_name = Window.orderBy(F.col("__source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.row_number().over(by_name) - 1) % len(weights) + 1)
    full_first = Window.orderBy("__ratio", F.col("__source").asc_nulls_last())
    before = full_first.rowsBetween(Window.unboundedPreceding, -1)
    after = full_first.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    return (sources.withColumn("__weight", weight)
            .withColumn("__cap", F.col("__total") * most)
            .withColumn("__ratio", F.col("__cap") / F.col("__weight"))
            .withColumn("__level",
                        (F.sum("__total").over(every) * share
                         - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
                        / F.sum("__weight").over(after))
            .withColumn("__target", F.when(F.col("__level") >= F.col("__ratio"), F.col("__cap")))
            .withColumn("__level", F.max(F.when(F.col("__target").isNull(), F.col("__level")))
                        .over(every))
            .withColumn("__target", F.coalesce("__target", F.col("__level") * F.col("__weight")))
            .select("__source", "__total", "__docs", "__target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        bin_docs: int = 4096, seed: int = 1) -> DataFrame:
    """Per document: `doc_id`, `size`, `source_size`, `target` (its source's), `taken` words."""
    sized = written(_sized(docs, doc_id, text, source, seed), "sizes")
    sources = targets(
        sized.groupBy("__source").agg(F.sum("__size").alias("__total"),
                                      F.count(F.lit(1)).alias("__docs")), weights, share, most)
    sources = written(sources, "targets")
    facts = sources.select(F.col("__source").alias("__s"), "__total", "__docs", "__target")
    # exp(-key) is near uniform where weights are near 1, and ascending keys are descending in it.
    bins = F.ceil(F.col("__docs") / bin_docs)
    dealt = (sized.join(facts, F.col("__source").eqNullSafe(F.col("__s"))).drop("__s")
             .withColumn("__bin", F.floor((1 - F.exp(-F.col("__key"))) * bins)))
    in_source = (Window.partitionBy("__source").orderBy("__bin")
                 .rowsBetween(Window.unboundedPreceding, -1))
    starts = (dealt.groupBy("__source", "__bin").agg(F.sum("__size").alias("__sum"))
              .withColumn("__start", F.coalesce(F.sum("__sum").over(in_source), F.lit(0)))
              .select(F.col("__source").alias("__s"), F.col("__bin").alias("__b"), "__start"))
    in_bin = (Window.partitionBy("__source", "__bin").orderBy("__key", "__id", "__hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    epochs = F.when(F.col("__total") > 0, F.floor(F.col("__target") / F.col("__total"))).otherwise(0)
    left = F.floor(F.col("__target")) - epochs * F.col("__total")
    before = F.col("__start") + F.col("__before")
    part = F.least(F.greatest(left - before, F.lit(0)), F.col("__size"))
    return (dealt.withColumn("__before", F.coalesce(F.sum("__size").over(in_bin), F.lit(0)))
            .join(starts, F.col("__source").eqNullSafe(F.col("__s"))
                  & (F.col("__bin") == F.col("__b")))
            .select(F.col("__id").alias("doc_id"), F.col("__size").alias("size"),
                    F.col("__total").alias("source_size"), F.col("__target").alias("target"),
                    (epochs * F.col("__size") + part).cast("long").alias("taken"),
                    F.col("__hash").alias("text_md5")))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str = "n_chars",
          **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, the last copy cut where need be."""
    taken = (mix(docs, doc_id, text, **options).filter("taken > 0")
             .groupBy(F.col("doc_id").alias("__id"), F.col("text_md5").alias("__md5"))
             .agg(F.count(F.lit(1)).alias("__n"), F.max("size").alias("__size"),
                  F.sum("taken").alias("__taken")))
    rows = docs.select(whole_row(docs).alias("__row"), F.col(doc_id).alias("__i"),
                       F.md5(F.coalesce(F.col(text), F.lit(""))).alias("__m"))
    repeats = Window.partitionBy("__i", "__m").orderBy(F.lit(1))
    joined = rows.join(taken, F.col("__i").eqNullSafe(F.col("__id"))
                       & (F.col("__m") == F.col("__md5")))
    # rows that repeat take their words one after the other
    joined = joined.withColumn("__nth", F.when(F.col("__n") == 1, 0)
                               .otherwise(F.row_number().over(repeats) - 1))
    each = F.floor(F.col("__taken") / F.col("__n"))
    own = F.when(F.col("__nth") == 0, F.col("__taken") - each * (F.col("__n") - 1)).otherwise(each)
    words = F.least(F.col("__size"), F.col("__own") - F.col("__copy") * F.col("__size"))
    head = F.array_join(F.slice(F.regexp_extract_all(
        F.col(f"__row.{text}"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)),
        F.lit(1), F.col("__words").cast("int")), "")
    cut = F.col("__words") < F.col("__size")
    out = (joined.withColumn("__own", own)
           .withColumn("__copy", F.explode(F.sequence(
               F.lit(0), F.ceil(F.col("__own") / F.col("__size")) - 1)))
           .withColumn("__words", words).filter("__words > 0")
           .withColumn("__row", F.when(cut, F.col("__row").withField(text, head))
                       .otherwise(F.col("__row"))))
    if length in docs.columns:
        out = out.withColumn("__row", F.when(cut, F.col("__row").withField(
            length, F.length(f"__row.{text}").cast(docs.schema[length].dataType)))
            .otherwise(F.col("__row")))
    return out.select("__row.*")
