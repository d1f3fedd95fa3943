import math
import re
from collections import Counter

import pytest

from ledgerlake.llm import lexical_search as S

ITEMS = "item_id long, text string, score string, `my col` int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                      re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, best=10):
    docs = [(r[0], Counter(words(r[1]))) for r in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, total = len(docs), sum(c.total() for _, c in docs)
    held = Counter(w for _, c in docs for w in c)
    out = []
    for item, text, *_ in items:
        asked = words(text)
        found = []
        for doc, counts in docs:
            n = counts.total()
            m = 100 - 75 + (75 * n * n_docs) // total
            score = 0
            for w in asked:
                if counts[w]:
                    worth = math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * held[w] + 1)))
                    score += worth * ((1000000000 * counts[w]) // (1000 * counts[w] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, doc) in enumerate(sorted(found, key=str_key)[:best])]
    return sorted(out, key=str)


def str_key(x):
    return x[0], x[1], x[2] or 0


@pytest.fixture
def asked(spark, corpus):
    texts = [r[1] for r in corpus(11) if r[1]]
    items = [(i, t[:i * 40 + 5], "x", 1) for i, t in enumerate(texts[3:25])]
    items += [(90, None, "x", 1), (91, "...", "x", 1), (92, "the THE the of", "x", 1), (93, "nowhere", "x", 1),
              (None, "of and the", "x", 1), (None, "éf q", "x", 1), items[2], (94, texts[-1], "x", 1)]
    return items, spark.createDataFrame(items, ITEMS)


@pytest.mark.parametrize("block, chunk, cells", [(100_000, 4 << 20, 4 << 20), (150, 2000, 300)])
def test_as_brute_force(documents, asked, block, chunk, cells, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(S, "CELLS", cells)
    items, bench = asked
    rows, df = documents(8, extra=[(5000 - i, "the of q and the", None, "s", 1, "", "", 0) for i in range(15)]
                         + [(None, "q the éf zebra", None, None, None, None, None, None)] * 2)
    got = S.search(df, bench, block_words=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, items)


def test_ties_between_tasks_go_to_the_smaller_id(spark):
    rows = [(i, "same words here" if i % 2 else "other text", "x") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, item string").repartition(7)
    bench = spark.createDataFrame([(1, "words here")], "item_id long, text string")
    got = S.search(df, bench, best=5).orderBy("rank").collect()
    assert [(r["rank"], r.doc_id) for r in got] == [(1, 1), (2, 3), (3, 5), (4, 7), (5, 9)]
    assert len({r.score for r in got}) == 1


def test_no_documents_no_items_no_words(spark, no_documents, asked):
    items, bench = asked
    assert S.search(no_documents, bench).collect() == []
    one = spark.createDataFrame([(1, "the")], "doc_id long, text string")
    assert S.search(one, bench.limit(0)).collect() == []
    assert S.search(spark.createDataFrame([(1, "... -")], "doc_id long, text string"), bench).collect() == []


def test_only_masks_that_can_count_are_evaluated(monkeypatch):
    import numpy as np
    import pyarrow as pa
    from ledgerlake.llm import text as T
    texts = ["rare word the"] * 12 + ["the of"] * 500 + ["of"] * 88
    chunk = next(T.chunks(pa.array(texts), 1 << 20))
    vocabulary = np.unique(S._words(next(T.chunks(pa.array(["rare the of"]))))[0])
    found = S._postings(vocabulary, chunk)
    m = S.lengths_of(found.lengths, 600, int(found.lengths.sum()))
    worth = S.weight(600, np.diff(found.offsets))
    seen = []
    share = S.share
    monkeypatch.setattr(S, "share", lambda times, m: (seen.append(np.shape(times)), share(times, m))[1])
    best = S.Best(10)
    S._evaluate(best, np.arange(3), worth, found, m, np.arange(600))
    assert best.ids.tolist() == list(range(10))
    assert [s for s in seen if len(s) == 2] == [(2, 12)]


def test_a_very_long_text_and_item(spark):
    long = "lorem ipsum dolor sit amet x%d " 
    text = " ".join(long % i for i in range(60_000))
    rows = [(1, text, None), (2, "ipsum", None), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a-b` string")
    items = [(1, text[:200_000]), (2, "ipsum x7")]
    got = S.search(df, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, items)
