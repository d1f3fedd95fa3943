import datetime as dt

import pytest

from ledgerlake.operators import quality as dq

STAMP = dt.datetime(2024, 1, 1)


def verdicts(df, rules):
    return {r.rule_name.split(".", 1)[1]: (r.passed, r.actual_value)
            for r in dq.table_report(df, rules).collect()}


def test_clean_transactions_pass_every_rule(transactions):
    got = verdicts(transactions({}, {"transaction_id": "t2"}), dq.silver_rules()["transactions"])
    assert len(got) == 8 and all(passed for passed, _ in got.values())
    assert got["non_empty"] == (True, "2")


@pytest.mark.parametrize("rule, rows", [
    ("null_key", [{"account_id": None}]),
    ("duplicate_key", [{}, {}]),
    ("channel_not_null", [{"channel": None}]),
    ("valid_amount", [{"amount": 0.0}]),
    ("valid_balance", [{"new_balance": -1.0}]),
    ("valid_type", [{"type": "refund"}]),
    ("valid_status", [{"status": "odd"}]),
])
def test_one_planted_fault_fails_one_rule(transactions, rule, rows):
    got = verdicts(transactions(*rows), dq.silver_rules()["transactions"])
    assert [name for name, (passed, _) in got.items() if not passed] == [rule]
    assert got[rule][1] == "1"


def test_an_empty_table_fails_only_that(transactions):
    got = verdicts(transactions({}).limit(0), dq.silver_rules()["transactions"])
    assert [n for n, (passed, _) in got.items() if not passed] == ["non_empty"]


def test_null_measures_pass_validation(transactions):
    got = verdicts(transactions({"amount": None, "type": None, "old_balance": None}),
                   dq.silver_rules()["transactions"])
    assert all(passed for passed, _ in got.values())


@pytest.mark.parametrize("rate, passed", [(0.0, True), (1.0, True), (-0.1, False), (1.1, False),
                                          (None, False)])
def test_rate_rule(spark, rate, passed):
    df = spark.createDataFrame(
        [("u", 1, 1.0, rate, 1, STAMP, STAMP)],
        "user_id string, f_user_total_transactions_90d long,"
        " f_user_avg_transaction_amount_90d double, f_user_failed_transaction_rate_90d double,"
        " f_user_distinct_merchants_90d long, event_timestamp timestamp,"
        " created_timestamp timestamp")
    got = verdicts(df, dq.gold_rules()["feat_user_90d"])
    assert got["failed_transaction_rate_between_0_and_1"][0] is passed
    assert got["non_negative_metrics"][0] and got["unique_key(user_id)"][0]


def test_composite_keys_and_gold_names(spark):
    df = spark.createDataFrame(
        [("a", 1, STAMP.date(), -1.0), ("a", 1, STAMP.date(), 2.0)],
        "account_id string, date_key int, snapshot_date date, closing_balance double")
    got = verdicts(df, dq.gold_rules()["fact_balance_snapshot"])
    assert got == {"non_empty": (True, "2"), "required_columns_not_null": (True, "0"),
                   "unique_key(account_id,snapshot_date)": (False, "1"),
                   "non_negative_metrics": (False, "1")}


def test_row_count_contracts(spark):
    tables = {"users": spark.range(3), "dim_user": spark.range(3), "facts": spark.range(2)}
    rows = {r.rule_name: r for r in dq.row_count_report(
        tables, [("users", "dim_user"), ("facts", "users")], across=True).collect()}
    good = rows["silver.users_count_equals_dim_user_count"]
    bad = rows["silver.facts_count_equals_users_count"]
    assert good.passed and good.actual_value == "3 vs 3"
    assert not bad.passed and bad.actual_value == "2 vs 3"


def test_foreign_keys_ignore_null_and_count_distinct_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "p int")
    row = dq.foreign_key_report(child, parent, "k", "p", "r").first()
    assert (row.passed, row.actual_value) == (False, "1")
    assert dq.foreign_key_report(child.filter("k = 1"), parent, "k", "p", "r").first().passed


def test_gate_raises_with_the_failed_rules(transactions):
    dq.transaction_gate(transactions({}))
    with pytest.raises(dq.DataQualityError, match="channel_not_null: actual=1"):
        dq.transaction_gate(transactions({"channel": None}))
    with pytest.raises(dq.DataQualityError, match="duplicate_key"):
        dq.transaction_gate(transactions({}, {}))
    with pytest.raises(dq.DataQualityError, match="non_empty"):
        dq.transaction_gate(transactions({}).limit(0))
