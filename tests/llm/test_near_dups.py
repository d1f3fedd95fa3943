import random
import re

import numpy as np
import pytest

from ledgerlake.llm import graph
from ledgerlake.llm import near_dups as N


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(s), least[root(i)], d == least[root(i)]) for i, (d, s) in enumerate(sets))


def near_copies(seed, groups=4, copies=40):
    """Groups whose members are edited copies of one another, some far from most of their group."""
    rng, rows, i = random.Random(seed), [], 2000
    for _ in range(groups):
        text = [f"w{rng.randrange(10_000)}" for _ in range(rng.choice([12, 60, 200]))]
        for _ in range(copies):
            if rng.random() < 0.2:
                text = list(text)
                text[rng.randrange(len(text))] = f"e{rng.randrange(10_000)}"
            words = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 60))):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10_000)}"
            rows.append((i, " ".join(words), None, "s", 0, "", "", 0))
            i += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_as_brute_force(documents, seed):
    rows, df = documents(seed, extra=near_copies(seed))
    assert sorted(tuple(r) for r in N.near_duplicates(df).collect()) == brute(rows)
    kept = N.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in brute(rows) if r[3])


def test_lists_in_blocks_as_brute_force(documents, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    rows, df = documents(5, 5, extra=near_copies(7, 3, 60))
    assert sorted(tuple(r) for r in N.near_duplicates(df).collect()) == brute(rows)


def test_repeated_rows_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(3, text), (3, text), (None, text), (None, "else"), (4, None), (5, "")],
                               "doc_id long, text string")
    got = sorted(map(str, (tuple(r) for r in N.near_duplicates(df).collect())))
    assert got == sorted(map(str, [(3, 26, 3, True), (3, 26, 3, True), (None, 26, 3, False),
                                   (None, 1, None, True), (4, 0, 4, True), (5, 0, 5, True)]))
    assert sorted(str(r.doc_id) for r in N.one_of_each(df).collect()) == ["3", "4", "5", "None"]


def test_no_documents(no_documents):
    assert N.near_duplicates(no_documents).count() == 0 and N.one_of_each(no_documents).count() == 0


def test_less_than_75_is_refused(no_documents):
    with pytest.raises(ValueError):
        N.near_duplicates(no_documents, percent=60)


def test_estimate_is_exact_on_whole_sets():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 60, 30)).astype(np.uint64) for _ in range(2))
        got = N.estimate(N._padded([a.tobytes()]), N._padded([b.tobytes()]))[0]
        assert got == pytest.approx(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 480)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}
    for a, b in edges:
        parent.setdefault(a, a), parent.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(parent[a], parent[b])
            changed |= parent[a] != low or parent[b] != low
            parent[a] = parent[b] = low
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {k: v for k, v in got.items()} == {k: parent[k] for k in linked if k in got}
    assert all(parent[k] == k for k in linked - got.keys())
