import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerlake.llm import conversation_trie as C

TURNS = "conv_id long, turn long, role string, text string, path string, `my col` int"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - c % 5, []) if c >= 0 else own.get(c + -c % 5, [])
        path = tuple(base[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p],
                    saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
                   for p, m in members.items()), key=str)


def conversations(seed, n=120):
    rng = random.Random(seed)
    texts = ["a", "é", "", None, "long text " * 9, "x/y", "12:ab"]
    rows = []
    for c in rng.sample(range(-20, 400), n):
        if rng.random() < 0.3:  # copies of one conversation
            rows += [(c, t, "user", f"same {t}", "p", 1) for t in range(6)]
            continue
        for t in range(rng.choice([1, 2, 3, 8, 12, 30])):
            turn = None if rng.random() < 0.05 else t
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(texts), "p", 1))
    rows += [rows[0], rows[-1], (None, 1, "user", "no id", "p", 1), (10**12, 0, "user", "a", "p", 1)]
    return rows


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("shard, chunk", [(8 << 20, 8192), (1500, 3), (120, 1)])
def test_as_brute_force(spark, seed, shard, chunk, monkeypatch):
    monkeypatch.setattr(C, "CHUNK_IDS", chunk)
    rows = conversations(seed)
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    got = C.report(df, shard_bytes=shard)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_copies_of_one_conversation_are_spread(spark, monkeypatch):
    rows = [(c, t, "user", f"turn {t}", "p", 1) for c in range(0, 3000, 5) for t in range(3)]
    rows += [(c, 0, "user", "", "p", 1) for c in range(5000, 5030)]
    df = spark.createDataFrame(rows, TURNS)
    paths = C.rebuild(C.paths(df)).selectExpr("conv_id", "unhex(array_join(own.digest, '')) as path")
    splitters = C._splitters(paths, 4000, 1 << 20)
    assert len({p for p, _ in splitters}) < len(splitters) > 8
    got = C.report(df, shard_bytes=4000)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_a_bound_on_the_skeleton_makes_fewer_shards(spark):
    rows = conversations(5)
    df = spark.createDataFrame(rows, TURNS)
    assert C.skeleton([]).parents.tolist() == [-1]
    got = C.report(df, shard_bytes=300, skeleton_bytes=2000)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_long_conversations_and_texts(spark):
    rows = [(c, t, "user", str(t), "p", 1) for c in (0, 1, 2) for t in range(120)]
    rows += [(3, 0, "user", "x" * 3_000_000, "p", 1), (4, 0, None, None, "p", 1)]
    got = C.report(spark.createDataFrame(rows, TURNS).repartition(4), shard_bytes=2000)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    deep = [(c, t, "user", str(t), "p", 1) for c in (0, 5) for t in range(20_000)]
    got = C.report(spark.createDataFrame(deep, TURNS).repartition(4), shard_bytes=200_000)
    assert {r[0] for r in got.groupBy("n_convs").count().collect()} == {2} and got.count() == 20_001


def test_no_conversations_and_only_turnless_ones(spark):
    none = spark.createDataFrame([], TURNS)
    assert C.report(none).collect() == []
    lone = [(c, 0, "user", "a", "p", 1) for c in (1, 2, 3, 4)]  # the first of their five is not there
    got = C.report(spark.createDataFrame(lone, TURNS))
    assert sorted(map(tuple, got.collect()), key=str) == brute(lone)
