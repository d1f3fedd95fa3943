"""Odd column names, and one very long text, through the stages and the operators on words."""

import resource

import corpus_pipeline as P
import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import decontaminate, host_quality, mixing, near_dups, training_order
from ledgerlake.llm import text as T

ODD = ("doc_id long, text string, lang string, source string, n_chars long, `my col` int, `a-b` string,"
       " `x.y` struct<`p q`: int>, __row string, __host string")


@pytest.fixture
def odd(spark):
    rows = [(i, f"word{i} " + "some more words to read " * 12 + f"{i} end", "en", "s", 9, i, "b", (i,), "r", "h")
            for i in range(12)]
    return spark.createDataFrame(rows + [(99, None, None, None, None, None, None, None, None, None)], ODD)


def test_odd_columns_pass_through_the_stages(spark, odd):
    items = spark.createDataFrame([(1, "nothing of the kind is here to be found at all")], "item_id long, text string")
    for out in (host_quality.keep_good(odd), near_dups.one_of_each(odd), decontaminate.keep_clean(odd, items),
                mixing.mixed(odd)):
        assert out.columns == odd.columns and out.schema["x.y"].dataType == odd.schema["x.y"].dataType
        assert all(r["my col"] is None or r["x.y"]["p q"] == r["my col"] for r in out.collect())


def test_hashes_of_long_texts_are_those_of_short_ones():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 3 * T.CHUNK_BYTES + 12345, dtype=np.uint8)
    starts = rng.integers(0, len(data) - 50, 500)
    ends = starts + rng.integers(1, 50, 500)
    got = T.Hasher(data, 4)(starts, ends)
    want = [T.Hasher(data[a:b], 4)(np.array([0]), np.array([b - a]))[0] for a, b in zip(starts, ends)]
    assert got.tolist() == want
    long = T.Hasher(data, 4)(np.array([5]), np.array([len(data)]))
    assert long != T.Hasher(data, 4)(np.array([6]), np.array([len(data)]))


def test_one_very_long_text_takes_bounded_memory():
    text = "lorem ipsum dolor sit amet consectetur " * 1_000_000  # 39 MB
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for inside in (T.SPACED, T.ALNUM):
        for seed in (0, 1):
            chunk = next(T.chunks(pa.array([text])))
            found = T.words(chunk, inside)
            assert len(np.unique(T.Hasher(chunk.data, seed)(found.starts, found.ends))) == 6
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_500_000  # KB
    assert sum(x[0].nbytes + x[1].nbytes for x in (T._powers(0), T._powers(1))) < 40_000_000


def test_a_long_text_in_training_order(spark):
    docs = spark.createDataFrame([(1, "lorem ipsum " * 300_000), (2, None), (3, "x")], "doc_id long, text string")
    out = training_order.write_shards(docs)
    with open(training_order.TOKENIZER, "rb") as f:
        encoder = training_order.Encoder(f.read())
    want = encoder._bpe.encode_ordinary("lorem ipsum " * 300_000)
    assert out.groupBy("doc_id").sum("n_tokens").filter("doc_id = 1").first()[1] == len(want) + 1


def test_stages_are_those_of_the_pipeline():
    assert len(P.STAGES) == 5
