import hashlib
import re

import numpy as np
import pytest

from ledgerlake.llm import decontaminate as D
from ledgerlake.llm.fm_index import FMIndex

ITEMS = "item_id long, text string, kept string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    windows = {}
    for item, text, _ in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add("" if item is None else str(item))
    lengths = sorted({len(w) for w in windows})
    out = []
    for r in rows:
        w = words(r[1])
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    found |= own
        out.append((r[0], len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture
def benchmark(spark, corpus):
    def build(seed):
        rows = corpus(seed)
        texts = [r[1] for r in rows if r[1] and len(r[1].split()) > 30]
        items = [(i, " ".join(t.split()[i:i + 12 + i]), "x") for i, t in enumerate(texts[:12])]
        items += [(100, None, "x"), (101, "...", "x"), (102, "éf the", "x"), (103, "nowhere to be found", "x"),
                  (None, texts[3][:90], "x"), items[0], (104, "ab", "x")]
        return items, spark.createDataFrame(items, ITEMS)
    return build


@pytest.mark.parametrize("block", [200_000, 7])
def test_as_brute_force(documents, benchmark, block, monkeypatch):
    monkeypatch.setattr(D, "SHARD_BYTES", 3000)
    items, bench = benchmark(6)
    rows, df = documents(6, extra=[(5000, "Ab, éF-the", None, "s", 1, "", "", 0)] * 2
                         + [(None, None, None, None, None, None, None, None)])
    found = D.contamination(df, bench, block_windows=block)
    got = [(r.key, r.n_words, sum(s.last - s.first for s in r.spans), len(r["items"]),
            hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), bool(r.spans)) for r in found.collect()]
    assert sorted(got, key=str) == brute(rows, items)
    if block > 7:
        assert sorted((tuple(r) for r in D.report(df, bench).collect()), key=str) == brute(rows, items)
        clean = D.keep_clean(df, bench)
        assert clean.columns == df.columns
        assert (sorted(str(r.doc_id) for r in clean.collect())
                == sorted(str(r[0]) for r in brute(rows, items) if not r[5]))


def test_spans_are_maximal_runs_of_their_text():
    hit = np.array([1, 1, 1, 0, 1], bool)
    assert D._spans(hit, np.array([0, 2, 2, 5])) == [
        [{"first": 0, "last": 2}], [], [{"first": 0, "last": 1}, {"first": 2, "last": 3}]]


def test_nothing_to_find(documents, no_documents, benchmark, spark):
    _, bench = benchmark(6)
    rows, df = documents(6, 5)
    empty = spark.createDataFrame([], ITEMS)
    assert D.report(no_documents, bench).count() == 0
    assert D.report(df, empty).filter("contaminated").count() == 0
    assert D.keep_clean(df, empty).count() == len(rows)


def test_index_finds_all_places():
    rng = np.random.default_rng(2)
    for _ in range(30):
        symbols = rng.integers(0, 5, rng.integers(1, 200))
        index = FMIndex(symbols, 4)
        for n in (1, 2, 3):
            phrases = rng.integers(1, 5, (20, n))
            low, high = index.search(phrases)
            for p, a, b in zip(phrases, low, high):
                want = [i for i in range(len(symbols) - n + 1) if (symbols[i:i + n] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want
