import re

import pytest

from ledgerlake.llm import mixing as M


def water(sizes: dict, weights, share, most):
    """Shares by weight; who is above the cap is set to it and the excess shared anew."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        level = left / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if level * weight[s] >= most * sizes[s]]
        if not above:
            return full | {s: level * weight[s] for s in free}
        for s in above:
            full[s] = most * sizes[s]
            left -= full[s]


@pytest.mark.parametrize("share, most", [(1.5, 2.0), (0.4, 2.0), (3.0, 2.0)])
def test_takes_what_the_targets_ask(documents, share, most):
    rows, df = documents(2, extra=[(5000, "ab cd ef", None, "s2", 1, "", "", 0)] * 3
                         + [(None, None, None, None, None, None, None, None)])
    got = M.mix(df, share=share, most=most, bin_docs=4).collect()
    size = lambda t: len(re.findall(M.WORDS, t or ""))
    sources = {}
    for r in rows:
        sources[r[3]] = sources.get(r[3], 0) + size(r[1])
    targets = water(sources, (3, 1, 2), share, most)
    of = {r[0]: r for r in rows}
    taken = dict.fromkeys(sources, 0)
    for r in got:
        source = of[r.doc_id][3]
        assert r.size == size(of[r.doc_id][1]) and r.source_size == sources[source]
        assert r.target == pytest.approx(targets[source]) and 0 <= r.taken <= most * r.size
        taken[source] += r.taken
    assert len(got) == len(rows)
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sources)
    again = M.mix(df.repartition(7), share=share, most=most, bin_docs=9).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_the_mix_holds_what_was_taken(documents):
    rows, df = documents(3, extra=[(5000, "ab cd  ef", None, "s2", 1, "", "", 0)] * 3)
    want = {}
    for r in M.mix(df).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    got, out = {}, M.mixed(df)
    assert out.columns == df.columns
    of = {r[0]: r[1] or "" for r in rows}
    for r in out.collect():
        assert of[r.doc_id].startswith(r.text) and r.n_chars in (len(r.text), 1)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(re.findall(M.WORDS, r.text))
    assert got == {k: v for k, v in want.items() if v}


def test_no_documents(no_documents):
    assert M.mix(no_documents).count() == 0 and M.mixed(no_documents).count() == 0


def test_no_python_in_the_plan(documents, plan_of):
    _, df = documents(4, 10)
    assert "Python" not in plan_of(M.mix(df), run=False) and "Arrow" not in plan_of(M.mixed(df), run=False)
