import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import kneser_ney as K
from ledgerlake.llm import text as T


def tokens(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return ["<", "<", *words, ">"]


class Brute:
    def __init__(self, texts):
        three = Counter(tuple(t[i - 2:i + 1]) for t in map(tokens, texts) for i in range(2, len(t)))
        two = Counter(g[1:] for g in three)
        one = Counter(g[1:] for g in two)
        self.levels = [one, two, three]
        self.off = [K.discounts(*(sum(c == k for c in x.values()) for k in (1, 2, 3, 4))) for x in self.levels]
        self.after = []
        for level in self.levels:
            after = defaultdict(list)
            for g, c in level.items():
                after[g[:-1]].append(c)
            self.after.append(after)

    def p(self, gram):
        if not gram:
            return 1 / (len(self.levels[0]) + 1)
        i = len(gram) - 1
        lower = self.p(gram[1:])
        seen = self.after[i].get(gram[:-1])
        if not seen:
            return lower
        off, c = self.off[i], self.levels[i][gram]
        own = max(c - off[min(c, 3) - 1], 0) if c else 0
        return (own + sum(off[min(x, 3) - 1] for x in seen) * lower) / sum(seen)

    def log10(self, text):
        t = tokens(text)
        return sum(math.log10(self.p(tuple(t[i - 2:i + 1]))) for i in range(2, len(t)))


def test_as_brute_force(spark, documents):
    rows, _ = documents(5, 40)
    texts = [r[1] for r in rows][:30]
    model = K.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    brute = Brute(texts)
    others = [r[1] for r in rows]
    (chunk,) = T.chunks(pa.array(others, pa.string()))
    got_tokens, offsets = K.tokens_of(chunk)
    logs = np.concatenate([[0], np.cumsum(model.log10(got_tokens, offsets))])
    ends = offsets - 2 * np.arange(len(offsets))
    for text, a, b in zip(others, ends[:-1], ends[1:]):
        assert logs[b] - logs[a] == pytest.approx(brute.log10(text), rel=1e-4)


def test_strange_text_goes_and_trusted_text_stays(spark):
    import random
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    good = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 80))) for _ in range(400)]
    rows = [(i, t, "en" if i % 2 else None) for i, t in enumerate(good)]
    rows += [(1000 + i, " ".join(f"{rng.random()}" for _ in range(30)), "en") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(300)] + [(None,)], "doc_id long")
    got = {r.doc_id: r for r in K.classify(df, trusted, per_language=60).collect()}
    assert not any(got[1000 + i].kept for i in range(20))
    assert np.mean([got[i].kept for i in range(400)]) > 0.97
    for r in got.values():
        assert r.perplexity == pytest.approx(10 ** (-r.log10_prob / r.n_tokens))


def test_edge_cases(spark, documents, no_documents):
    trusted = spark.createDataFrame([], "doc_id long")
    rows, df = documents(5, 10, extra=[(None, None, None, None, None, None, None, None)])
    out = K.classify(df, trusted)
    assert out.count() == len(rows) and out.filter("kept").count() == len(rows)
    some = spark.createDataFrame([(r[0],) for r in rows[:15]], "doc_id long")
    out = K.classify(df, some)
    assert out.count() == len(rows)
    assert K.classify(no_documents, some).count() == 0


def test_discounts():
    assert K.discounts(0, 1, 1, 1) == (0.5, 0.5, 0.5)
    one, two, three = K.discounts(100, 40, 20, 10)
    assert 0 < one < two < three < 3


@pytest.mark.parametrize("buckets", [1, 40])
def test_all_trusted_texts_are_trained_on_in_buckets(spark, documents, monkeypatch, buckets):
    """Counts by bucket, frequent words dealt out, give what the model of all trusted texts gives."""
    rows, df = documents(5, 60, extra=[(None, None, None, None, None, None, None, None)] * 2)
    text = {i: t for i, t, *_ in rows}
    trusted = spark.createDataFrame([(r[0],) for r in rows[:50]], "doc_id long")
    monkeypatch.setattr(K, "BUCKET_BYTES", 1 + sum(len((t or "").encode()) for t in text.values()) // buckets)
    fifth = {r.id for r in df.select("doc_id").distinct().selectExpr(
        "doc_id AS id", "pmod(xxhash64(doc_id), 5) AS f").collect() if r.f == 0}
    learned = [r[1] for r in rows[:50] if r[0] is not None and r[0] not in fifth]
    brute = Brute(learned)
    out = K.classify(df, trusted, sent_bytes=0, slices=2)
    got = out.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    for r in got:
        assert r.n_tokens == len(tokens(text[r.doc_id])) - 2
        assert r.log10_prob == pytest.approx(brute.log10(text[r.doc_id]), rel=1e-4)
    whole = {str(r.doc_id): r for r in K.classify(df, trusted).collect()}
    for r in got:
        assert r.log10_prob == pytest.approx(whole[str(r.doc_id)].log10_prob, rel=1e-4)
        assert r.kept == whole[str(r.doc_id)].kept
    assert K.Buckets.of(np.array([0, 0, 50, 30, 5, 5, 10]), 40).dealt(np.arange(9)).sum() == 3


def test_texts_beyond_five_hundred_of_a_language_are_trained_on(spark):
    rows = [(i, f"common words every time only{i}", "en") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = K.classify(df, df.select("doc_id"))
    held = {r.doc_id for r in df.filter("pmod(xxhash64(doc_id), 5) = 0").collect()}
    worst = max(-r.log10_prob for r in out.collect() if r.doc_id not in held)
    assert worst < min(-r.log10_prob for r in out.collect() if r.doc_id in held)
