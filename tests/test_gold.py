import datetime as dt
import random

import pytest

from ledgerlake.operators import features, merchants, model, profile
from ledgerlake.operators.enrich import enrich_transactions


def users(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id string")


def test_feature_window_includes_both_ends(spark, transactions):
    top = dt.datetime(2024, 6, 1, 12)
    edge = top - dt.timedelta(days=90)
    df = transactions(
        {"transaction_id": "1", "timestamp": top}, {"transaction_id": "2", "timestamp": edge},
        {"transaction_id": "3", "timestamp": edge - dt.timedelta(microseconds=1)})
    row = features.user_features_90d(df, users(spark, "u1")).first()
    assert row[features.TOTAL] == 2
    assert row.event_timestamp == top


def test_users_without_activity_get_zeros(spark, transactions):
    df = transactions({"merchant_id": None, "status": "failed"})
    rows = {r.user_id: r for r in
            features.user_features_90d(df, users(spark, "u1", "idle")).collect()}
    names = (features.TOTAL, features.AVERAGE, features.FAILED_RATE, features.MERCHANTS)
    assert [rows["u1"][n] for n in names] == [1, 10.0, 1.0, 0]
    assert [rows["idle"][n] for n in names] == [0, 0.0, 0.0, 0]


def test_features_of_an_empty_fact_fail(spark, transactions):
    with pytest.raises(Exception, match="the table is empty"):
        features.user_features_90d(transactions({}).limit(0), users(spark, "u1")).collect()


def test_date_dimension_holds_observed_dates_only(spark):
    def one(column, *days):
        return spark.createDataFrame([(d,) for d in days], f"{column} string").selectExpr(
            f"cast({column} as timestamp) as {column}")
    dates = model.dim_date(one("timestamp", "2024-01-06 10:00:00", None),
                           one("login_ts", "2024-01-08 01:00:00"),
                           one("snapshot_date", "2024-01-06 00:00:00")).collect()
    assert sorted((d.date_key, d.day_of_week, d.is_weekend, d.quarter) for d in dates) == [
        (20240106, "Saturday", True, 1), (20240108, "Monday", False, 1)]


def test_wide_table_keeps_every_fact_row(spark, transactions):
    fact = model.fact_transactions(transactions(
        {"transaction_id": "1"}, {"transaction_id": "2", "merchant_id": None},
        {"transaction_id": "3", "user_id": "nobody"}))
    stamp = dt.datetime(2024, 1, 1)
    out = enrich_transactions(
        fact,
        spark.createDataFrame([("u1", True, stamp)],
                              "user_id string, kyc_verified boolean, created_at timestamp"),
        spark.createDataFrame([("a1", "points", "VND", stamp)],
                              "account_id string, account_type string, currency string,"
                              " created_at timestamp"),
        spark.createDataFrame([("d1", "mobile", "x", stamp)],
                              "device_id string, device_type string, os string,"
                              " first_seen_at timestamp"),
        spark.createDataFrame([("m1", "Shop", "grocery")],
                              "merchant_id string, merchant_name string, category string"),
        model.dim_date(fact, fact.selectExpr("timestamp AS login_ts"),
                       fact.selectExpr("timestamp AS snapshot_date")))
    rows = {r.transaction_id: r for r in out.collect()}
    assert len(out.columns) == 32 and len(rows) == 3
    assert rows["1"].merchant_name == "Shop" and rows["2"].merchant_name is None
    assert rows["3"].kyc_verified is None and rows["3"].account_type == "points"


def test_merchant_forms_agree_and_keep_idle_merchants(spark, transactions):
    rng = random.Random(3)
    tx = transactions(*[
        {"transaction_id": str(i), "merchant_id": rng.choice(["m1"] * 8 + ["m2", None]),
         "amount": float(rng.randint(1, 50)), "user_id": rng.choice("uvw"),
         "status": rng.choice(["success", "failed", "pending"])} for i in range(200)])
    shops = spark.createDataFrame(
        [("m1", "A", "x"), ("m2", "B", "x"), ("idle", "C", "x")],
        "merchant_id string, merchant_name string, category string")

    def sorted_rows(df):
        return sorted(tuple(r) for r in df.collect())

    plain = sorted_rows(merchants.merchant_workload(tx, shops))
    assert plain == sorted_rows(merchants.merchant_workload(tx, shops, salts=7))
    assert plain == sorted_rows(merchants.merchant_workload_join_first(tx, shops))
    assert plain[0] == ("idle", "C", "x", 0, 0.0, 0.0, 0, 0)
    full = {r.merchant_id: r for r in merchants.merchant_performance(tx, shops).collect()}
    assert full["m1"].distinct_users == 3 and full["idle"].distinct_users == 0


def test_skew_profile_against_a_plain_computation(spark):
    counts = [50, 9, 9, 4, 4, 4] + [1] * 37
    rows = [(f"k{i}",) for i, n in enumerate(counts) for _ in range(n)] + [(None,)] * 5
    got = profile.skew_profile(spark.createDataFrame(rows, "k string"), "k").first()
    top = profile.top_key_count(len(counts))
    assert (got.total_rows, got.distinct_keys, got.top_keys) == (sum(counts), len(counts), top)
    assert got.top_share_pct == sum(counts[:top]) / sum(counts) * 100
    assert (got.max_rows, got.min_rows, got.median_rows) == (50, 1, 1.0)
    assert got.max_median_ratio == 50.0


def test_lists_of_a_hot_key_come_in_chunks_of_one_size(spark):
    rows = [("hot", i) for i in range(1000)] + [("cold", 1), ("cold", 2), (None, 3)] + [("same", 5)] * 250
    out = profile.list_by_key(spark.createDataFrame(rows, "k string, v long").repartition(3), "k", "v", "vs",
                              chunk=100).collect()
    of = {(r.k, r.part): r.vs for r in out}
    assert of == ({("hot", p): list(range(p * 100, p * 100 + 100)) for p in range(10)} | {("cold", 0): [1, 2]}
                  | {("same", p): [5] * n for p, n in enumerate((100, 100, 50))})


def test_distinct_compare_of_nothing_has_no_error(spark):
    empty = spark.createDataFrame([], "k string")
    assert profile.distinct_compare(empty, "k").first().relative_error_pct == 0.0
    for rsd in (0, 1, -0.1):
        with pytest.raises(ValueError):
            profile.distinct_approx(empty, "k", rsd)


def test_latest_balance_fills_missing_accounts(spark):
    accounts = spark.createDataFrame([("a", "u"), ("b", "v")], "account_id string, user_id string")
    snaps = spark.createDataFrame([("a", "2024-01-01", 1.0), ("a", "2024-01-02", 2.0)],
                                  "account_id string, snapshot_date string, closing_balance double")
    assert {r.account_id: r.balance for r in
            profile.latest_balance(accounts, snaps).collect()} == {"a": 2.0, "b": 0.0}


def test_wide_rows_are_shuffled_once_for_large_dimensions(spark, transactions):
    rows = [{"transaction_id": str(i), "user_id": u, "account_id": a, "device_id": d}
            for i, (u, a, d) in enumerate([("u1", "a1", "d1"), ("u1", "a1", "d1"), (None, "a1", None),
                                           ("u2", None, "d1"), (None, None, None), ("u1", "zz", "d2")])]
    fact = model.fact_transactions(transactions(*rows, rows[0]))
    stamp = dt.datetime(2024, 1, 1)
    dims = (spark.createDataFrame([("u1", True, stamp), ("u2", False, stamp), (None, True, stamp)],
                                  "user_id string, kyc_verified boolean, created_at timestamp"),
            spark.createDataFrame([("a1", "points", "VND", stamp)], "account_id string, account_type string,"
                                  " currency string, created_at timestamp"),
            spark.createDataFrame([("d1", "mobile", "x", stamp), ("d2", "tablet", "y", stamp)],
                                  "device_id string, device_type string, os string, first_seen_at timestamp"),
            spark.createDataFrame([("m1", "Shop", "grocery")],
                                  "merchant_id string, merchant_name string, category string"))
    days = model.dim_date(fact, fact.selectExpr("timestamp AS login_ts"), fact.selectExpr("timestamp AS snapshot_date"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = enrich_transactions(fact, *dims, days)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        got = sorted((r.transaction_id, r.kyc_verified, r.account_type, r.device_type) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert got == [("0", True, "points", "mobile")] * 2 + [
        ("1", True, "points", "mobile"), ("2", None, "points", None), ("3", False, None, "mobile"),
        ("4", None, None, None), ("5", True, None, "tablet")]
    joins = [n for n in plan.split("\n") if "Join LeftOuter" in n]
    assert len(joins) == 6 and sum("strategy=broadcast" in n for n in joins) == 2
