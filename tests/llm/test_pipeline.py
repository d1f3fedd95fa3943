"""The stages of the pipeline, each against brute force on what it was given."""

import importlib
import re

import corpus_pipeline as P
import duckdb
import pyarrow as pa
import pytest
import test_decontaminate as decontaminate
import test_host_quality as host_quality
import test_near_dups as near_dups
from ledgerlake.llm import training_order
from ledgerlake.llm.host_quality import Rules
from ledgerlake.llm.text import chunks

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        docs = P.written(stage(spark, docs, SF), name)
        out.append(docs)
    return [sorted((tuple(r[c] for c in COLUMNS) for r in x.collect()), key=str) for x in out[:-1]] + [out[-1].collect()]


def test_stages(steps):
    first, good, single, clean, mix, shards = steps
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "source_mixing",
                                        "training_shards"]
    kept = {r[0] for r in host_quality.verdicts([(r[0], r[1], r[2], r[3]) for r in first], Rules()) if r[7]}
    assert good == [r for r in first if r[0] in kept]
    assert [r[0] for r in sorted(single)] == [r[0] for r in near_dups.brute(good) if r[3]]
    items = duckdb.sql(f"SELECT item_id, text, '' FROM '{SF}/benchmark.parquet'").fetchall()
    assert sorted(r[0] for r in clean) == sorted(r[0] for r in decontaminate.brute(single, items) if not r[5])
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    total, of = sum(size(r[1]) for r in clean), {r[0]: r for r in clean}
    assert all(of[r[0]][1].startswith(r[1]) and of[r[0]][2:4] == r[2:4] for r in mix)
    assert abs(sum(size(r[1]) for r in mix) - 1.5 * total) <= len({r[3] for r in clean})
    with open(training_order.TOKENIZER, "rb") as f:
        encoder = training_order.Encoder(f.read())
    assert sum(r.n_tokens for r in shards) == sum(len(encoder.encode(c)[0]) for c in chunks(pa.array([r[1] for r in mix])))
    assert sorted(r.slot for r in shards) == list(range(len(shards)))
    assert {r.doc_id for r in shards} == {r[0] for r in mix}


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    assert entry.queries()["pipeline"] is P.run
