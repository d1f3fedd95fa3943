import datetime as dt
import random

import pytest

from ledgerlake.operators import features, incremental
from ledgerlake.operators.model import fact_transactions

NAMES = (features.TOTAL, features.AVERAGE, features.FAILED_RATE, features.MERCHANTS)


def table(df):
    return {r.user_id: (*(pytest.approx(r[c]) for c in NAMES), r.event_timestamp) for r in df.collect()}


@pytest.fixture
def days(transactions):
    """days(7, 3): the rows of two days since 2024-01-01, always the same for one day and version."""
    def build(*numbers, version=0):
        rows = []
        for n in numbers:
            rng = random.Random(n * 100 + version)
            for i in range(rng.randint(5, 12)):
                rows.append({
                    "transaction_id": f"{n}-{i}", "user_id": rng.choice(["u1"] * 6 + ["u2", "u3", "u4"]),
                    "merchant_id": rng.choice(["m1", "m1", "m2", None]), "amount": float(rng.randint(1, 50)),
                    "status": rng.choice(["success", "failed", "pending"]),
                    "timestamp": dt.datetime(2024, 1, 1) + dt.timedelta(n, rng.randrange(86400))})
        return fact_transactions(transactions(*rows))
    return build


def test_loads_give_the_features_of_a_full_run(spark, days, tmp_path):
    users = spark.createDataFrame([(u,) for u in ("u1", "u2", "u3", "u4", "idle")], "user_id string")
    path, out = str(tmp_path / "partials"), None
    # a new day, the same again, a gap that moves the window past all rows of a user, and a corrected old day
    loads = [((0, 1, 2), 0), ((3,), 0), ((3,), 0), ((9,), 0), ((8,), 1), ((10,), 0)]
    held = {}
    for numbers, version in loads:
        held.update(dict.fromkeys(numbers, version))
        fact = days(*(n for n in held if not held[n])) if 1 not in held.values() else (
            days(*(n for n in held if not held[n])).union(days(*(n for n in held if held[n]), version=1)))
        out = incremental.refresh_user_features(path, days(*numbers, version=version), fact, users, out, days=7)
        out = incremental.written(out, "features")
        assert table(out) == table(features.user_features_90d(fact, users, days=7))
    assert table(out)["idle"][0] == 0


def test_a_corrected_day_takes_back_what_it_had(spark, transactions, at, tmp_path):
    users = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    path = str(tmp_path / "partials")
    first = fact_transactions(transactions({"transaction_id": "a", "user_id": "u1"},
                                           {"transaction_id": "b", "user_id": "u2"}))
    again = fact_transactions(transactions({"transaction_id": "b", "user_id": "u2"}))
    out = incremental.written(incremental.refresh_user_features(path, first, first, users), "features")
    assert table(out)["u1"][0] == 1
    out = incremental.refresh_user_features(path, again, again, users, out)
    assert table(out)["u1"][0] == 0 and table(out)["u2"][0] == 1


def test_only_touched_users_are_computed_anew(spark, transactions, at, tmp_path):
    users = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    path = str(tmp_path / "partials")
    one = fact_transactions(transactions({"transaction_id": "a", "user_id": "u1", "timestamp": at("10:00:00", 5)},
                                         {"transaction_id": "b", "user_id": "u2", "timestamp": at("11:00:00", 5)}))
    before = incremental.written(incremental.refresh_user_features(path, one, one, users), "features")
    marked = before.withColumn(features.TOTAL, before[features.TOTAL] + 100)  # shows who is taken over
    two = fact_transactions(transactions({"transaction_id": "c", "user_id": "u1", "timestamp": at("10:00:00", 6)}))
    out = incremental.refresh_user_features(path, two, one.union(two), users, marked)
    assert {u: r[0].expected for u, r in table(out).items()} == {"u1": 2, "u2": 101}


def test_no_time_at_all_is_an_error(spark, transactions, tmp_path):
    none = fact_transactions(transactions({})).filter("false")
    with pytest.raises(ValueError):
        incremental.refresh_user_features(
            str(tmp_path / "partials"), none, none, spark.createDataFrame([], "user_id string"))


def test_a_day_is_not_cut_into_many_files(spark, tmp_path, at):
    import glob
    rows = [(f"u{i}", None, "success", 1.0, at("10:00:00", day=1 + i % 2)) for i in range(64)]
    fact = spark.createDataFrame(rows, "user_id string, merchant_id string, status string, amount double,"
                                       " timestamp timestamp")
    out = incremental.refresh_user_features(str(tmp_path), fact, fact, fact.select("user_id").distinct())
    assert out.count() == 64
    assert [len(glob.glob(f"{day}/*.parquet")) for day in glob.glob(f"{tmp_path}/day=*")] == [1, 1]
