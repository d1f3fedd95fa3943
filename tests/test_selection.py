import random
from collections import Counter

import pytest

from ledgerlake.operators import profile


@pytest.mark.parametrize("share", [0.001, 0.05, 0.3, 1.0])
@pytest.mark.parametrize("most", [1, 3, 40])
def test_top_members_are_those_of_a_full_sort(spark, share, most):
    rng = random.Random(most)
    keys = [k for k in range(300) for _ in range(rng.randint(1, most))]
    rows = [(f"k{k:03d}",) for k in keys] + [(None,)] * 5
    got = profile.top_members(spark.createDataFrame(rows, "k string").repartition(4), "k", share)
    ranked = sorted(Counter(r[0] for r in rows if r[0]).items(), key=lambda x: (-x[1], x[0]))
    assert sorted(r.k for r in got.collect()) == sorted(
        k for k, _ in ranked[:profile.top_key_count(len(ranked), share)])


def test_top_members_of_nothing_and_of_one_hot_key(spark):
    none = spark.createDataFrame([(None,)], "k string")
    assert profile.top_members(none, "k").collect() == []
    hot = spark.createDataFrame([("a",)] * 500 + [("b",)], "k string")
    assert [r.k for r in profile.top_members(hot, "k").collect()] == ["a"]


def test_top_members_collect_and_sort_nothing_whole(spark, plan_of):
    rows = spark.createDataFrame([(i % 97,) for i in range(1000)], "k long")
    plan = plan_of(profile.top_members(rows, "k"))
    assert "TakeOrdered" not in plan and "CollectLimit" not in plan


def test_sketches_of_days_merge_and_reload(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = [(f"2024-01-{d:02d}", f"u{i}", i % 3, None) for d in range(1, 11) for i in range(d * 20)]
    df = spark.createDataFrame(rows, "day string, user string, kind int, nothing string")
    columns = ["user", "kind", "nothing"]
    for days in (("2024-01-01", "2024-01-05"), ("2024-01-06", "2024-01-10"), ("2024-01-04", "2024-01-06")):
        part = df.filter(df.day.between(*days))
        profile.add_sketches(profile.daily_sketches(part, columns, "day"), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 30
    got = {r.column_name: r.approx_distinct for r in profile.distinct_between(stored).collect()}
    assert got["kind"] == 3 and got["nothing"] in (0, None) and abs(got["user"] - 200) <= 10
    early = {r.column_name: r.approx_distinct for r in profile.distinct_between(stored, last="2024-01-02").collect()}
    assert abs(early["user"] - 40) <= 2
    assert profile.distinct_between(stored, first="2025-01-01").collect() == []
