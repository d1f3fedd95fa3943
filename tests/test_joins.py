import datetime as dt
import random

import pytest

from ledgerlake.operators import change, joins

DAY = dt.datetime(2024, 1, 1)


def as_of_by_definition(labels, features):
    out = []
    for key, when, tag in labels:
        known = [f for f in features if f[0] == key and key is not None and f[1] <= when]
        best = max(known, key=lambda f: (f[1], f[2]), default=None)
        out.append((key, when, tag, best and best[1], best and best[3]))
    return sorted(map(str, out))


@pytest.mark.parametrize("seed, rows_per_task", [(1, 10**6), (2, 5), (3, 1)])
def test_as_of_matches_the_definition(spark, seed, rows_per_task):
    rng = random.Random(seed)

    def moment():
        return DAY + dt.timedelta(hours=rng.randint(0, 24 * 6))

    labels = [(rng.choice(["hot"] * 6 + ["a", "b", None]), moment(), i) for i in range(120)]
    features, seen = [], set()
    for i in range(80):
        row = (rng.choice(["hot", "a", "c"]), moment(), DAY + dt.timedelta(hours=i), float(i))
        if row[:3] not in seen:
            seen.add(row[:3])
            features.append(row)
    got = joins.as_of(
        spark.createDataFrame(labels, "k string, at timestamp, tag long"),
        spark.createDataFrame(features, "k string, ft timestamp, made timestamp, v double"),
        "k", "at", "ft", "made", ["v"], rows_per_task=rows_per_task)
    assert got.columns == ["k", "at", "tag", "feature_time", "v"]
    assert sorted(str(tuple(r)) for r in got.collect()) == as_of_by_definition(labels, features)


def test_as_of_never_sees_the_future_and_takes_the_newest_version(spark):
    labels = spark.createDataFrame([("a", DAY)], "k string, at timestamp")
    features = spark.createDataFrame(
        [("a", DAY, DAY, 1.0), ("a", DAY, DAY + dt.timedelta(1), 2.0),
         ("a", DAY + dt.timedelta(microseconds=1), DAY, 3.0)],
        "k string, ft timestamp, made timestamp, v double")
    assert joins.as_of(labels, features, "k", "at", "ft", "made", ["v"]).first().v == 2.0


def test_left_lookup_with_spread_nulls_is_a_left_join(spark, plan_of):
    left = spark.createDataFrame(
        [(i, None if i % 3 else f"k{i % 4}") for i in range(50)], "id long, k string")
    dim = spark.createDataFrame([("k0", "x"), ("k1", "y"), (None, "never")], "k string, v string")
    got = joins.left_lookup(left, dim, "k", spread_nulls_by="id")
    want = left.join(dim, "k", "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_null_keys_are_spread_over_partitions(spark):
    left = spark.range(2000).selectExpr("id", "if(id < 0, 'k0', null) k")
    dim = spark.createDataFrame([("k0", "x")], "k string, v string")
    options = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        def used(df):
            return df.selectExpr("spark_partition_id() p").distinct().count()
        assert used(joins.left_lookup(left, dim, "k")) == 1
        assert used(joins.left_lookup(left, dim, "k", spread_nulls_by="id")) == 4
    finally:
        for k in options:
            spark.conf.unset(k)


def test_upserted_prefers_versions_then_updates(spark):
    current = spark.createDataFrame([("a", 1, "old"), ("b", 5, "old"), ("c", 1, "old")],
                                    "k string, v int, s string")
    updates = spark.createDataFrame([("a", 1, "new"), ("b", 4, "new"), ("d", 1, "new")],
                                    "k string, v int, s string")
    out = change.upserted(current, updates, ["k"], ["v"]).collect()
    assert {r.k: r.s for r in out} == {"a": "new", "b": "old", "c": "old", "d": "new"}


def test_upsert_in_place_touches_only_changed_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1, "p1"), ("b", 1, "p1"), ("c", 1, "p2")],
                          "k string, v int, p string").write.partitionBy("p").parquet(path)
    before = sorted(f.name for f in (tmp_path / "t" / "p=p2").iterdir())
    schema = "k string, v int, p string"
    current = spark.read.schema(schema).parquet(path)
    updates = spark.createDataFrame([("a", 2, "p1"), ("z", 1, "p3")], schema)
    change.upsert_partitions(current, updates, path, ["k"], ["v"], "p")
    got = spark.read.schema(schema).parquet(path).collect()
    assert sorted(map(tuple, got)) == [("a", 2, "p1"), ("b", 1, "p1"), ("c", 1, "p2"),
                                       ("z", 1, "p3")]
    assert sorted(f.name for f in (tmp_path / "t" / "p=p2").iterdir()) == before
    moved = spark.createDataFrame([("c", 9, "p1")], schema)
    with pytest.raises(ValueError, match="move"):
        change.upsert_partitions(spark.read.schema(schema).parquet(path), moved, path, ["k"],
                                 ["v"], "p", check_moves=True)
    moved = spark.createDataFrame([("a", 9, "p3")], schema).union(spark.createDataFrame([("b", 9, "p1")], schema))
    with pytest.raises(ValueError, match="move"):
        change.upsert_partitions(spark.read.schema(schema).parquet(path), moved, path, ["k"],
                                 ["v"], "p")


def test_replace_table_may_read_what_it_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    change.replace_table(spark.read.parquet(path).filter("id < 3"), path)
    assert spark.read.parquet(path).count() == 3


def test_change_log_forms(spark):
    lines = [
        '{"op":"c","source":{"lsn":1},"before":null,"after":{"id":"a","n":1}}',
        '{"payload":{"op":"u","source":{"lsn":2},"before":null,"after":{"id":"a","n":2}}}',
        '{"op":"r","source":{"lsn":1},"after":{"id":"b","n":1}}',
        '{"op":"d","source":{"lsn":3},"before":{"id":"b","n":1},"after":null}',
        '{"op":"c","source":{"lsn":4},"after":{"id":"b","n":7}}',
        '{"op":"c","source":{"lsn":5},"after":{"id":"c","n":1}}',
        '{"op":"d","source":{"lsn":6},"before":{"id":"c","n":1}}']
    log = change.decode_changes(
        spark.createDataFrame([(v,) for v in lines], "value string"), "id string, n int")
    assert sorted(map(tuple, change.apply_changes(log, ["id"]).collect())) == [("a", 2), ("b", 7)]


def test_as_of_settles_missing_and_equal_versions(spark, at):
    labels = spark.createDataFrame([("a", at("10:00:00")), (None, at("10:00:00")), ("b", None)], "k string, at timestamp")
    features = spark.createDataFrame(
        [("a", at("09:00:00"), None, 1.0), ("a", at("09:00:00"), 2, 2.0), ("a", at("09:00:00"), 2, 3.0)],
        "k string, ft timestamp, made int, v double")
    got = joins.as_of(labels, features, "k", "at", "ft", "made", ["v"]).collect()
    assert sorted((str(r.k), r.v) for r in got) == [("None", None), ("a", 3.0), ("b", None)]


def test_upsert_keeps_rows_without_partition_and_omitted_columns(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, v int, w int, p string"
    spark.createDataFrame([("a", 1, 5, None), ("b", 1, 6, None), ("c", 1, 7, "x")], schema).write.partitionBy(
        "p").parquet(path)
    current = spark.read.schema(schema).parquet(path)
    updates = spark.createDataFrame([("a", 2, None)], "k string, v int, p string")
    change.upsert_partitions(current, updates, path, ["k"], ["v"], "p")
    got = sorted(map(str, map(tuple, spark.read.schema(schema).parquet(path).collect())))
    assert got == sorted(map(str, [("a", 2, 5, None), ("b", 1, 6, None), ("c", 1, 7, "x")]))


def test_bad_envelopes_are_set_aside_and_encoded_values_read(spark):
    lines = ['{"op":"c","source":{"lsn":1},"after":{"id":"a","n":"AN3Q","at":1000000}}',
             '{"op":"c","source":{"lsn":2},"after":{"id":"b","n":"/w==","at":0}}',
             '{"op":"c","source":{"lsn":3},"after":{"id":"c","n":"12.5"}}', None,
             '{"op":"c","source":{"lsn":4},"after":{"n":1}}', '{"op":"x","source":{"lsn":5},"after":{"id":"d"}}',
             "cut off"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    kind = "id string, n double, at timestamp"
    got = change.decode_changes(df, kind, keys=["id"], decimals={"n": 2}, micros=["at"]).collect()
    assert sorted((r.id, r.n) for r in got) == [("a", 567.84), ("b", -0.01), ("c", 12.5)]
    bad = change.malformed_changes(df, kind, keys=["id"], decimals={"n": 2}, micros=["at"])
    assert sorted(r.value for r in bad.collect()) == sorted(lines[4:])
