import re
from collections import Counter

import pytest

from ledgerlake.llm import host_quality as H


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i:i + 3])] > 1}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(hit))


def verdicts(rows, rules):
    hosts, out = {}, []
    for r in rows:
        m = brute(r[1])
        base = m[0] < rules.least_words or 100 * m[4] > rules.most_repeat_percent * m[0]
        more = (100 * m[2] > rules.most_symbol_percent * m[0] or m[3] > rules.most_dup_lines
                or not rules.least_word_chars * m[0] <= m[1] <= rules.most_word_chars * m[0])
        n, f = hosts.get(r[3], (0, 0))
        hosts[r[3]] = (n + 1, f + (base or more))
        out.append((r[0], *m, base, more, r[3]))
    n, f = (sum(h[i] for h in hosts.values()) for i in (0, 1))
    a, b = H.beta_prior(n, f, len(hosts), sum(h[1] ** 2 / h[0] for h in hosts.values()))
    rate = {k: (h[1] + a) / (h[0] + a + b) for k, h in hosts.items()}
    return [(*r[:7], not r[6] and rate[r[8]] < rules.reject_rate
             and not (rate[r[8]] > rules.suspect_rate and r[7])) for r in out]


@pytest.mark.parametrize("rules", [H.Rules(), H.Rules(least_words=10, most_symbol_percent=0),
                                   H.Rules(reject_rate=0.3), H.Rules(suspect_rate=0.99, reject_rate=1.1)])
def test_as_brute_force(documents, rules):
    rows, df = documents(1, extra=[(5000, "ab\nab\n \nab", None, "s1", 1, "", "", 0)] * 2
                         + [(None, None, None, None, None, None, None, None)])
    got = H.judge(df, rules=rules)
    assert got.columns[:8] == ["doc_id", *H.MEASURES, "base_failed", "kept"]
    key = str
    assert sorted((tuple(r)[:8] for r in got.collect()), key=key) == sorted(verdicts(rows, rules), key=key)
    kept = sorted((r.doc_id for r in H.keep_good(df, rules=rules).collect()), key=key)
    assert kept == sorted((r[0] for r in verdicts(rows, rules) if r[7]), key=key)
    assert H.keep_good(df, rules=rules).columns == df.columns


def test_a_bad_host_takes_its_documents_along_and_a_small_one_does_not(spark):
    good = " ".join(f"word{i} other{i * 7}" for i in range(40))
    rows = ([(i, "bad", "host-bad") for i in range(200)] + [(200, good, "host-bad")]
            + [(300 + i, f"{good} {i}", f"host-{i % 8}") for i in range(400)]
            + [(800, "bad", "tiny"), (801, good, "tiny")])
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in H.judge(df).collect()}
    assert not kept[200] and kept[801] and all(kept[i] for i in range(300, 700))


def test_no_documents(no_documents):
    assert H.judge(no_documents).count() == 0 and H.keep_good(no_documents).count() == 0


def test_prior():
    assert H.beta_prior(0, 0, 0, 0.0) == (1.0, 1.0)
    assert H.beta_prior(100, 0, 4, 0.0) == (0.0, 10_000.0)
