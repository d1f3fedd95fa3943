import random

import pytest

from ledgerlake.sources.compaction import compact_small, curve, file_name, manifest, read_live, retire


def listed(df):
    return sorted(map(tuple, df.selectExpr("string(day)", "a", "b").collect()), key=str)


def test_small_files_go_large_ones_stay_and_later_loads_join(spark, tmp_path):
    root, rng = str(tmp_path / "my table"), random.Random(1)

    def load(day, n, files):
        rows = [(day, rng.randrange(1000), rng.choice([None, rng.random()])) for _ in range(n)]
        (spark.createDataFrame(rows, "day string, a long, b double").repartition(files)
         .write.mode("append").partitionBy("day").parquet(f"{root}/data"))
        return rows

    rows = load("2024-01-01", 20000, 1) + load("2024-01-01", 600, 6) + load("2024-01-02", 50, 1)
    plain = {r.f for r in spark.read.parquet(f"{root}/data").select(
        file_name().alias("f")).distinct().collect()}
    assert compact_small(spark, root, ("a", "b"), ("day",), small=50_000, target=3_000) == 1
    live = {r.file for r in manifest(spark, root).collect()}
    # the large file and the only one of its day keep their names
    assert len(live & plain) == 2 and len(plain) == 8
    assert listed(read_live(spark, root)) == sorted(rows, key=str)
    rows += load("2024-01-02", 40, 2)
    assert len(listed(read_live(spark, root))) == len(rows) - 40  # not live before the next manifest
    compact_small(spark, root, ("a", "b"), ("day",), small=50_000)
    assert manifest(spark, root).count() == 3  # the large file, and one for each day
    assert listed(read_live(spark, root)) == sorted(rows, key=str)
    some = read_live(spark, root, {"a": (10, 200), "b": (0.0, 0.3)})
    assert listed(some) == sorted(
        [r for r in rows if 10 <= r[1] <= 200 and r[2] is not None and r[2] <= 0.3], key=str)
    assert retire(spark, root) > 0
    assert listed(read_live(spark, root)) == sorted(rows, key=str)


@pytest.mark.parametrize("bounds", [[[], []], [[1], [5]]])
def test_curve_takes_bits_in_turn(spark, bounds):
    df = spark.createDataFrame([(0, 0), (2, 0), (0, 9), (2, 9), (None, None)], "a int, b int")
    got = [r[0] for r in df.select(curve(("a", "b"), bounds)).collect()]
    assert got == ([0, 1, 2, 3, 0] if bounds[0] else [0] * 5)
