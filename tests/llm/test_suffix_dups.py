import hashlib

import numpy as np
import pytest

from ledgerlake.llm import suffix_dups as S


def brute(rows, length):
    first: dict[bytes, tuple] = {}
    order = sorted(rows, key=lambda r: r[0])
    out = []
    for d, text in order:
        raw = (text or "").encode()
        hit = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if raw[i:i + length] in first:
                hit[i:i + length] = True
            else:
                first[raw[i:i + length]] = (d, i)
        kept = bytes(b for b, h in zip(raw, hit) if not h)
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit.tolist()))
        out.append((d, len(raw), int(hit.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length, seed, piece", [(100, 1, 4 << 20), (100, 2, 500), (40, 3, 4 << 20), (33, 4, 200)])
def test_as_brute_force(documents, monkeypatch, length, seed, piece):
    monkeypatch.setattr(S, "PIECE", piece)
    rows, df = documents(seed)
    got = sorted(tuple(r) for r in S.report(df, length=length).collect())
    assert got == brute([r[:2] for r in rows], length)
    kept = {r.doc_id: hashlib.sha256(bytes(r.kept)).hexdigest() for r in S.without_repeats(df, length=length).collect()}
    assert kept == {r[0]: r[4] for r in got}


def test_repeated_rows_and_missing_ids(spark):
    text = "".join(chr(97 + i * i % 26) + str(i) for i in range(60))
    df = spark.createDataFrame([(3, text), (3, text), (None, text), (4, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in S.report(df).collect())
    n = len(text)
    assert got == [("3", n, 0), ("3", n, 0), ("4", 0, 0), ("None", n, n)]


def test_no_documents(no_documents):
    assert S.report(no_documents).count() == 0


def test_sliding_min():
    rng = np.random.default_rng(1)
    for n, width in ((10, 3), (7, 7), (50, 8), (64, 8), (5, 1)):
        x = rng.integers(0, 100, n).astype(np.uint64)
        assert S._sliding_min(x, width).tolist() == [x[i:i + width].min() for i in range(n - width + 1)]


@pytest.mark.parametrize("places, windows, shuffled", [(1, 1 << 18, False), (4096, 50, True)])
def test_many_places_small_blocks_and_shuffled_sides(documents, monkeypatch, places, windows, shuffled):
    monkeypatch.setattr(S, "PLACES", places)
    monkeypatch.setattr(S, "WINDOWS", windows)
    if shuffled:
        monkeypatch.setattr(S, "small_side", lambda df: df)
    rows, df = documents(5)
    assert sorted(tuple(r) for r in S.report(df, length=40).collect()) == brute([r[:2] for r in rows], 40)
