import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import packing as P

CLASH = "doc_id long, text string, `my col` int, `a-b` string, rank long, length long, ids string"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(P.TOKENIZER)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def whole(rows, documents, size):
    """Every id of every document is in exactly one piece, and sequences have no gaps."""
    want = Counter((doc, tuple(ids)) for doc, ids in documents)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= size
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for doc, ids in want:
        for r in by_doc[doc]:
            if r.doc_tokens == len(ids):
                own = np.array(ids[r.start:r.start + r.length], "<u4")
                if want[doc, ids] == sum(n for (d, _), n in want.items() if d == doc):
                    assert zlib.crc32(own.tobytes()) == r.ids_crc32
    assert Counter(d for d, n in want.items() for _ in range(n)).total() == sum(
        1 for r in rows if r.start == 0)
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in documents)


@pytest.mark.parametrize("size", [2048, 64])
def test_pieces_hold_every_id_once(documents, plain, size):
    rows, df = documents(3, extra=[(None, "x y", None, "s", 1, "", "", 0),
                                   (7001, "Don't  STOP ﬁ é ́a b <|endoftext|>z 12's", None, None, 1, "", "", 0)] * 2)
    got = P.pack(df, size=size).collect()
    whole(got, [(r[0], plain(r[1])) for r in rows], size)
    assert {r.doc_tokens for r in got if r.doc_id == 7001} == {len(plain(rows[-1][1]))}


def test_sequences_hold_the_ids_of_their_pieces(documents, plain):
    rows, df = documents(4)
    texts = {r[0]: plain(r[1]) for r in rows}
    packed = P.pack(df, size=128)
    for s in P.sequences(packed).collect():
        ids = np.frombuffer(s.ids, "<u4").tolist()
        for x in s.spans:
            assert ids[x.offset:x.offset + x.length] == texts[x.doc_id][x.start:x.start + x.length]


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_shortest_pack_first(seed):
    rng = random.Random(seed)
    size = 50
    histogram = Counter(rng.choice([rng.randint(1, size), 7, 30]) for _ in range(rng.randint(1, 400)))
    packs = []  # by hand, a piece at a time
    for length in sorted(histogram.elements(), reverse=True):
        at = min(range(len(packs)), key=lambda i: packs[i], default=None)
        if at is not None and packs[at] + length <= size:
            packs[at] += length
        else:
            packs.append(length)
    planned = P.plan(dict(histogram), size)
    assert Counter({f: n for f, n in Counter(packs).items()}) == sum(
        (Counter({size - p.space: p.count}) for p in planned), Counter())
    used = Counter()
    for p in planned:
        assert sum(k * n for k, n in p.pattern) == size - p.space
        for length, times in p.pattern:
            used[length] += times * p.count
    assert used == histogram


def test_one_length_for_most_documents_is_cut_to_fit():
    histogram = {1300: 100_000, 1999: 3, 5: 10}
    least = P.least_cut(histogram, 2048, 0.01)
    assert least and sum(P.cuts(1300, least)) == 1300
    pieces = Counter()
    for length, n in histogram.items():
        for piece in P.cuts(length, least):
            pieces[piece] += n
    assert P.padded(P.plan(pieces, 2048), 2048) < 0.01 * 1300 * 100_000
    assert P.least_cut({1024: 10, 1023: 10, 1: 10}, 2048, 0.01) == 0


def test_groups_stay_few_whatever_the_counts():
    rng = random.Random(1)
    packs = P.plan({n: rng.randint(1, 10**9) for n in range(1, 2049)}, 2048)
    assert len(packs) < 3 * 2048


def test_odd_columns_no_documents_and_the_shuffled_join(spark, plain, monkeypatch):
    odd = spark.createDataFrame([(1, "a b", 1, "x", 5, 6, "y"), (2, None, 1, "x", 5, 6, "y")], CLASH)
    assert {(r.doc_id, r.doc_tokens) for r in P.report(odd).collect()} == {(1, 3), (2, 1)}
    assert P.report(odd.limit(0)).collect() == []
    monkeypatch.setattr(P, "small_side", lambda df: df)
    texts = [(i, "word " * (i % 90)) for i in range(300)]
    got = P.pack(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), size=100).collect()
    whole(got, [(i, plain(t)) for i, t in texts], 100)


def test_a_very_long_text(spark, plain):
    text = "lorem ipsum dolor Sit amet " * 80_000
    got = P.report(spark.createDataFrame([(1, text), (2, "a")], "doc_id long, text string")).collect()
    whole(got, [(1, plain(text)), (2, plain("a"))], 2048)
