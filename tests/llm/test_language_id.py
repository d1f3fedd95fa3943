import random
import zlib

import numpy as np
import pyarrow as pa

from ledgerlake.llm import language_id as L
from ledgerlake.llm import text as T

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, size string, kept string,"
        " key long")

ALPHABETS = {"aa": "abcde", "bb": "deéüf", "cc": "xyzñ"}


def texts(n, seed=1):
    rng, rows = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(list(ALPHABETS))
        words = ("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(3, 8)))
                 for _ in range(rng.choice([3, 10, 80])))
        rows.append((i, " ".join(words), lang, "s", 0, "", "", 0))
    return rows


def test_held_out_accuracy_and_edge_cases(spark):
    rows = texts(900)
    odd = [(2000, None, "aa", None, 0, "", "", 0), (2001, "12 ,.", "bb", None, 0, "", "", 0),
           (2002, "", None, None, 0, "", "", 0), (None, "xyz xyz", None, None, 0, "", "", 0), rows[0]]
    got = L.identify(spark.createDataFrame(rows + odd, DOCS)).collect()
    assert len(got) == len(rows) + len(odd)
    of = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.doc_id in of and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert len(held) > 200 and np.mean([r.lang_pred == of[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (2000, 2001, 2002)] == ["und"] * 3 and by[2000].score == 0
    assert by[None].lang_pred in ALPHABETS
    right = [r.lang_pred == of[r.doc_id] for r in held if r.accepted]
    assert np.mean(right) >= 0.97


def test_prediction_reads_text_only(spark):
    rows = texts(120)
    a = L.identify(spark.createDataFrame(rows, DOCS)).collect()
    other = [(*r[:2], r[2] if zlib.crc32(str(r[0]).encode()) % 3 != 1 else None, "t", *r[4:]) for r in rows]
    b = L.identify(spark.createDataFrame(other, DOCS)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_nothing_to_learn_from(spark, no_documents):
    df = spark.createDataFrame([(1, "abc", None, None, 0, "", "", 0)], DOCS)
    assert [(r.lang_pred, r.score) for r in L.identify(df).collect()] == [("und", 0.0)]
    assert L.identify(no_documents).count() == 0


def test_a_chunk_is_averaged_text_by_text():
    rng = np.random.default_rng(1)
    model = L.Model(["a", "b"], rng.normal(size=(L.BUCKETS, 2)), np.array([0.1, 0.2]), 0.5)
    column = ["Abc déf", "", "x", None, "xy", "a long text of several words"]
    (chunk,) = T.chunks(pa.array(column))
    for got, text in zip(model.logits(chunk), column):
        want = L.features((text or "").encode()) @ model.table + model.bias
        assert np.allclose(got, want, atol=1e-5)
