import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import brown_lm as B
from ledgerlake.llm import text as T


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def held(doc):
    return zlib.crc32(str(doc).encode()) % 10 == 0


@pytest.mark.parametrize("shard", [1 << 20, 50])
def test_counts_and_base_as_brute_force(documents, monkeypatch, shard):
    monkeypatch.setattr(B, "SHARD_TOKENS", shard)
    rows, df = documents(3, extra=[(5000, "ab ab", None, None, 0, "", "", 0)] * 2)
    counts = Counter(t for r in rows if not held(r[0]) for t in tokens(r[1]))
    n, v = counts.total(), len(counts)
    got = sorted(B.score(df, frequent=12, classes=4).collect(), key=lambda r: r.doc_id)
    assert len(got) == len(rows)
    for r, row in zip(got, sorted(rows, key=lambda r: r[0])):
        own = tokens(row[1])
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            row[0], held(row[0]), len(own), sum(counts[t] > 0 for t in own), n)
        assert r.base_score == pytest.approx(base) and r.score < 0


def hashed(token):
    if token is None:
        return int(B.END.astype(np.int64))
    data = np.frombuffer(token.encode(), np.uint8)
    return int(T.Hasher(data)(np.array([0]), np.array([len(data)])).view(np.int64)[0])


def kept_in(tables):
    """Writes as the operator does and keeps the last table of each label."""
    def run(df, label, store=B.written):
        tables[label] = store(df, label)
        return tables[label]
    return run


@pytest.mark.parametrize("shards", [1, 12])
def test_score_as_brute_force_with_the_published_classes(documents, monkeypatch, shards):
    tables = {}
    monkeypatch.setattr(B, "written", kept_in(tables))
    rows, df = documents(3)
    got = sorted(B.score(df.repartition(shards), frequent=12, classes=4).collect(), key=lambda r: r.doc_id)
    assert tables["shards"].count() == shards
    known = {r.word: (r["class"], r.n) for r in tables["classed"].collect()}
    size = max(c for c, _ in known.values()) + 2
    grams, per_class, total = np.zeros((size, size)), Counter(), 0
    for c, n in known.values():
        per_class[c] += n + B.ADD
        total += n
    end = known[hashed(None)][0]
    spelled = {t: known.get(hashed(t), (size - 1, 0)) for r in rows for t in tokens(r[1])}
    for r in rows:
        before = end
        for t in tokens(r[1]) if not held(r[0]) else ():
            grams[before, spelled[t][0]] += 1
            before = spelled[t][0]
    moves = B.transitions(grams, sum(n == 1 for _, n in known.values()) / total)
    for r, row in zip(got, sorted(rows, key=lambda r: r[0])):
        want, before = 0.0, end
        for t in tokens(row[1]):
            c, n = spelled[t]
            want += moves[before, c] + (math.log10((n + B.ADD) / per_class[c]) if n else 0)
            before = c
        assert r.score == pytest.approx(want)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 9, (5, 5)).astype(float)
    grams[:, -1] = grams[-1] = 0
    assert np.allclose((10 ** B.transitions(grams, 0.1)).sum(1), 1)


def test_exchange_finds_classes_that_alternate():
    rng = np.random.default_rng(2)
    kind = np.array([0, 1, 2] * 5)
    m = np.zeros((16, 16))
    before = 0
    for _ in range(6000):
        after = rng.choice(np.flatnonzero(kind == (kind[before] + 1) % 3))
        m[before, after] += 1
        before = after
    own = B.exchange(m, 3)
    assert all(len(set(own[kind == k])) == 1 for k in range(3)) and len(set(own)) == 3


def test_structure_beats_word_counts(spark):
    import random
    rng, rows = random.Random(4), []
    lists = [[f"{p}{i}" for i in range(30)] for p in "abc"]
    for i in range(300):
        rows.append((i, " ".join(rng.choice(lists[k % 3]) for k in range(rng.randint(5, 60)))))
    got = B.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert (sum(r.score for r in got if r.held_out) > 0.8 * sum(r.base_score for r in got if r.held_out))


def test_nothing_to_learn_from(spark, no_documents):
    assert B.score(no_documents).count() == 0
    only = next(i for i in range(100) if held(i))
    (r,) = B.score(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_words_beyond_the_frequent_ones_are_exchanged(spark, monkeypatch):
    import random
    rng, tables = random.Random(6), {}
    monkeypatch.setattr(B, "written", kept_in(tables))
    lists = [[f"{p}{i}" for i in range(40)] for p in "abc"]
    rows = [(i, " ".join(rng.choice(lists[k % 3]) for k in range(60))) for i in range(400)]
    B.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), frequent=4,
            classes=4).collect()
    found = {r.word: r["class"] for r in tables["classed"].collect()}
    of = [{found[hashed(w)] for w in words} for words in lists]
    assert all(len(x) == 1 for x in of) and len(set.union(*of)) == 3


def test_each_move_raises_the_likelihood():
    rng = np.random.default_rng(5)
    m, own, k = rng.integers(0, 4, (30, 30)), rng.integers(0, 4, 30), 4

    def table(own):
        out = np.zeros((k + 1, k + 1))
        np.add.at(out, (own[:, None], own[None, :]), m)
        return out

    def likelihood(t):
        return B._x_log_x(t).sum() - B._x_log_x(t.sum(0)).sum() - B._x_log_x(t.sum(1)).sum()
    seen = np.array([[*np.bincount(own, m[:, w], k + 1), *np.bincount(own, m[w], k + 1), m[w, w]]
                     for w in range(30)]).astype(int)
    best = B.best_classes(table(own), own, np.ones(30, bool), seen)
    for w in range(30):
        tried = [likelihood(table(np.where(np.arange(30) == w, c, own))) for c in range(k)]
        assert tried[best[w]] == pytest.approx(max(tried))
    assert (best != own).any()


@pytest.mark.parametrize("least", [1, 3])
def test_a_sent_lookup_and_a_join_score_alike(documents, monkeypatch, least):
    monkeypatch.setattr(B, "SHARD_TOKENS", 300)
    _, df = documents(12)
    both = [sorted((tuple(r) for r in B.score(df, frequent=20, classes=4, least=least, lookup_words=n).collect()), key=str)
            for n in (10**6, 0)]
    assert both[0] == both[1]


def test_superseded_tables_are_deleted(documents, tmp_path, spark, monkeypatch):
    _, df = documents(13)
    labels = {}
    real = B.written
    monkeypatch.setattr(B, "written", lambda x, label: labels.setdefault((label, len(labels)), real(x, label)))
    B.score(df, frequent=10, classes=3).collect()
    gone = [k[0] for k, t in labels.items() if k[0] in ("near", "round")]
    assert len(gone) == 6
    from ledgerlake.sources.folders import names
    for (label, _), table in labels.items():
        folder = {f.rsplit("/", 1)[0] for f in table.inputFiles()}.pop()
        assert bool(names(spark, folder)) == (label not in ("near", "round"))


def test_tasks_get_shards_in_batches_of_bounded_size(documents, spark, monkeypatch):
    """Of a few bytes here, so that each shard comes alone; the session's options are put back."""
    monkeypatch.setattr(B, "BATCH_BYTES", 100, raising=False)

    def one_by_one(real):
        def made(*of):
            run = real(*of)

            def checked(batches):
                def seen():
                    for batch in batches:
                        assert batch.num_rows == 1
                        yield batch
                return run(seen())
            return checked
        return made
    for step in ("_bigrams", "_near", "_chosen", "_class_bigrams", "_scored"):
        monkeypatch.setattr(B, step, one_by_one(getattr(B, step)))
    options = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize",
               "parquet.page.size.row.check.min")
    before = [spark.conf.get(o, None) for o in options]
    rows, df = documents(14)
    assert B.score(df.repartition(12), frequent=12, classes=4).count() == len(rows)
    assert [spark.conf.get(o, None) for o in options] == before


def test_words_are_summed_over_batches():
    def batch(words, counts):
        return pa.RecordBatch.from_pydict({"words": [np.array(words, np.uint64).tobytes()],
                                           "counts": [np.array(counts, np.int64).tobytes()]})
    (got,) = B._word_counts(iter([batch([5, 7, 9], [1, 2, 0]), batch([7, 5], [4, 1])]))
    assert got.to_pydict() == {"word": [5, 7], "n": [2, 6]}
    assert not list(B._word_counts(iter([])))
