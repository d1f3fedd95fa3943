import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlake.functions import columns as X
from ledgerlake.operators import clean, dedup


def test_older_valid_copy_survives_an_invalid_newest(transactions, at):
    df = transactions({"amount": 5.0}, {"amount": -1.0, "ingested_at": at("11:00:00")})
    assert [r.amount for r in clean.clean_transactions(df).collect()] == [5.0]


def test_newest_valid_copy_wins(transactions, at):
    df = transactions({"amount": 5.0}, {"amount": 6.0, "ingested_at": at("11:00:00")})
    assert [r.amount for r in clean.clean_transactions(df).collect()] == [6.0]


def test_ties_are_settled_the_same_way_in_any_order(transactions):
    a, b = {"amount": 5.0, "merchant_id": None}, {"amount": 7.0}
    for rows in ((a, b), (b, a)):
        assert [r.amount for r in clean.clean_transactions(transactions(*rows)).collect()] == [7.0]


def test_channel_forms(transactions):
    df = transactions(*[{"transaction_id": str(i), "channel": c}
                        for i, c in enumerate([None, " App ", "UNKNOWN", "", "WEB"])])
    got = {r.transaction_id: r.channel for r in clean.clean_transactions(df).collect()}
    assert got == {"0": "UNKNOWN", "1": "app", "4": "web"}


def test_absent_channel_becomes_the_missing_marker(transactions):
    df = clean.clean_transactions(transactions({}).drop("channel"))
    assert df.first().channel == "UNKNOWN"


@pytest.mark.parametrize("column", ["transaction_id", "account_id", "user_id", "timestamp",
                                    "ingested_at", "amount", "old_balance", "new_balance"])
def test_null_in_a_required_column_drops_the_row(transactions, column):
    assert clean.clean_transactions(transactions({column: None})).count() == 0


@pytest.mark.parametrize("fault", [{"amount": 0.0}, {"old_balance": -1.0}, {"new_balance": -0.1},
                                   {"type": "refund"}, {"status": "odd"}, {"currency": "USD"},
                                   {"type": None}, {"status": None}, {"currency": None}])
def test_faulty_rows_are_dropped(transactions, fault):
    assert clean.clean_transactions(transactions(fault)).count() == 0


def test_failed_transactions_are_valid(transactions):
    assert clean.clean_transactions(transactions({"status": "failed"})).count() == 1


def test_strict_casts_fail_and_lenient_ones_quarantine(transactions):
    df = transactions({}, {"transaction_id": "t2"}).withColumn(
        "amount", F.when(F.col("transaction_id") == "t2", "x").otherwise("3.5"))
    with pytest.raises(PySparkException):
        clean.clean_transactions(df).collect()
    assert [r.amount for r in clean.clean_transactions(df, strict=False).collect()] == [3.5]
    assert [r.transaction_id for r in clean.quarantine_transactions(df).collect()] == ["t2"]


def test_dimension_cleaners_need_their_keys(spark):
    users = spark.createDataFrame(
        [("u1", "2024-01-01"), ("u1", "2024-01-02"), (None, "2024-01-03")],
        "user_id string, created_at string")
    assert [(r.user_id, str(r.created_at)) for r in clean.clean_users(users).collect()] == [
        ("u1", "2024-01-02 00:00:00")]
    devices = spark.createDataFrame(
        [("d1", "u1", "2024-01-01"), ("d2", None, "2024-01-01")],
        "device_id string, user_id string, first_seen_at string")
    assert [r.device_id for r in clean.clean_devices(devices).collect()] == ["d1"]


def test_snapshots_are_unique_per_account_and_day(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01", "5"), ("a", "2024-01-01", "7"), ("a", "2024-01-02", "-1"),
         ("a", None, "1"), ("b", "2024-01-01", None)],
        "account_id string, snapshot_date string, closing_balance string")
    assert [(r.account_id, r.closing_balance) for r in
            clean.clean_balance_snapshots(df).collect()] == [("a", 7.0)]


def test_repeat_stats_count_null_as_one_key(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    row = dedup.repeat_stats(df, "k").first()
    assert (row.total_rows, row.distinct_keys, row.duplicate_rows, row.duplicate_rate) == (
        4, 2, 2, 0.5)
    assert dedup.repeat_stats(df.limit(0), "k").first().duplicate_rate == 0.0


def test_balance_rule(spark):
    rows = [("deposit", 1.0, 3.0, 2.0, True), ("deposit", 1.0, 3.1, 2.0, False),
            ("payment", 5.0, 3.0, 2.0, True), ("withdraw", 5.0, 5.0, 2.0, False),
            ("other", 5.0, 99.0, 2.0, True)]
    df = spark.createDataFrame(rows, "t string, o double, n double, a double, ok boolean")
    got = df.select(X.balance_consistent(*map(F.col, "tona")).alias("got"), "ok").collect()
    assert all(r.got == r.ok for r in got)


def test_time_helpers(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:05:00' AS a,"
                   " TIMESTAMP '1969-12-31 23:59:59.999999' AS b")
    row = df.select(
        X.window_start(F.col("a")).cast("string"), X.window_end(F.col("a")).cast("string"),
        X.window_end(F.col("b")).cast("string"),
        X.epoch_millis(F.lit("2024-01-01T00:00:00.250")),
        X.iso_time(F.lit(1704067200000)), X.iso_time(F.lit(1704067200250))).first()
    assert tuple(row) == (
        "2024-01-01 00:05:00", "2024-01-01 00:10:00", "1970-01-01 00:00:00", 1704067200250,
        "2024-01-01T00:00:00", "2024-01-01T00:00:00.250000")
