import datetime as dt
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def at():
    """at("00:05:10") or at("00:05:10.5", day=2): a moment in January 2024."""
    def moment(clock: str, day: int = 1) -> dt.datetime:
        return dt.datetime.fromisoformat(f"2024-01-{day:02d}T{clock}")
    return moment


TX = ("transaction_id string, account_id string, user_id string, device_id string, type string,"
      " amount double, currency string, status string, channel string, old_balance double,"
      " new_balance double, merchant_id string, counterparty_account_id string,"
      " timestamp timestamp, ingested_at timestamp")


@pytest.fixture
def transactions(spark, at):
    """Build raw transactions from partial rows; whatever is not given is a valid default."""
    names = [f.split()[0] for f in TX.split(", ")]

    def build(*rows: dict):
        base = dict(
            transaction_id="t1", account_id="a1", user_id="u1", device_id="d1", type="payment",
            amount=10.0, currency="VND", status="success", channel="app", old_balance=100.0,
            new_balance=90.0, merchant_id="m1", counterparty_account_id=None,
            timestamp=at("10:00:00"), ingested_at=at("10:00:00"))
        return spark.createDataFrame(
            [tuple({**base, **row}[n] for n in names) for row in rows], TX)
    return build


@pytest.fixture
def plan_of():
    """The physical plan as text, after running the frame so that AQE has had its say."""
    def text(df, run: bool = True) -> str:
        if run:
            df.write.format("noop").mode("overwrite").save()
        return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return text
