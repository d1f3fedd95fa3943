"""Wallet tables derived from the supplied TPC-H-like Parquet tables.

Each text is one SELECT that means the same in Spark and in DuckDB; `{name}` stands for a raw
table. Nothing is random: faults (repeats, bad domains, negative balances, late events) come out
of the data itself.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_DAY_OF_YEAR = ("CAST(TIMESTAMP '1994-01-01 00:00:00' + CAST(c_custkey % 365 AS INT)"
                " * INTERVAL '1' DAY AS TIMESTAMP)")

_EVENT_TIME = ("CAST(CASE WHEN event_id % 8 = 0 THEN ts - CAST(5 + event_id % 1436 AS INT)"
               " * INTERVAL '1' MINUTE ELSE ts END AS TIMESTAMP)")

VIEWS: dict[str, str] = {
    "users": f"""
SELECT CAST(c_custkey AS STRING) AS user_id, c_name AS full_name,
  concat(lower(c_mktsegment), '@example.com') AS email, CAST(c_nationkey AS STRING) AS phone,
  c_acctbal >= 0 AS kyc_verified, {_DAY_OF_YEAR} AS created_at
FROM {{customer}}""",
    "accounts": f"""
SELECT CAST(c_custkey AS STRING) AS account_id, CAST(c_custkey AS STRING) AS user_id,
  CASE WHEN c_custkey % 10 = 0 THEN 'points' ELSE 'wallet_vnd' END AS account_type,
  'VND' AS currency, {_DAY_OF_YEAR} AS created_at
FROM {{customer}}""",
    "merchants": """
SELECT CAST(s_suppkey AS STRING) AS merchant_id, s_name AS merchant_name,
  CASE s_nationkey % 6 WHEN 0 THEN 'grocery' WHEN 1 THEN 'ecommerce' WHEN 2 THEN 'utility'
    WHEN 3 THEN 'transport' WHEN 4 THEN 'food_delivery' ELSE 'entertainment' END AS category
FROM {supplier}""",
    "devices": f"""
SELECT CAST(c_custkey AS STRING) AS device_id, CAST(c_custkey AS STRING) AS user_id,
  CASE c_custkey % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'tablet' ELSE 'desktop' END AS device_type,
  CASE c_custkey % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iPadOS' ELSE 'Linux' END AS os,
  {_DAY_OF_YEAR} AS first_seen_at
FROM {{customer}}""",
    "transactions": """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS transaction_id,
  CAST(o_custkey AS STRING) AS account_id, CAST(o_custkey AS STRING) AS user_id,
  CAST(o_custkey AS STRING) AS device_id,
  CASE WHEN l_quantity = 48 THEN 'refund' WHEN l_linenumber % 4 = 0 THEN 'deposit'
    WHEN l_linenumber % 4 = 1 THEN 'payment' WHEN l_linenumber % 4 = 2 THEN 'transfer'
    ELSE 'withdraw' END AS type,
  CASE WHEN l_quantity = 50 THEN 0.0 ELSE l_extendedprice END AS amount,
  CASE WHEN l_quantity = 49 THEN 'USD' ELSE 'VND' END AS currency,
  CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'F' THEN 'failed' ELSE 'pending' END AS status,
  CASE WHEN l_shipdate < TIMESTAMP '1998-01-01 00:00:00' THEN NULL
    WHEN o_orderpriority = '1-URGENT' THEN ' App ' WHEN o_orderpriority = '2-HIGH' THEN 'WEB'
    WHEN o_orderpriority = '3-MEDIUM' THEN 'atm' WHEN o_orderpriority = '5-LOW' THEN 'app'
    ELSE 'UNKNOWN' END AS channel,
  c_acctbal AS old_balance,
  CASE WHEN o_orderstatus = 'F' THEN c_acctbal
    WHEN l_linenumber % 4 = 0 THEN c_acctbal + l_extendedprice
    WHEN c_acctbal >= l_extendedprice THEN c_acctbal - l_extendedprice
    ELSE c_acctbal END AS new_balance,
  CASE WHEN l_linenumber % 4 = 1 THEN CAST(CASE WHEN l_partkey % 5 < 4 THEN l_suppkey % 5
    ELSE l_suppkey END AS STRING) END AS merchant_id,
  CASE WHEN l_linenumber % 4 = 2 THEN CAST(l_partkey AS STRING) END AS counterparty_account_id,
  CAST(o_orderdate + CAST(CASE WHEN l_quantity < 38 THEN 7 + (l_linenumber % 3)
    ELSE l_linenumber * 3 END AS INT) * INTERVAL '1' HOUR AS TIMESTAMP) AS timestamp,
  CAST(l_shipdate AS TIMESTAMP) AS ingested_at
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey""",
    "balance_snapshots": """
SELECT CAST(o_custkey AS STRING) AS account_id, CAST(o_orderdate AS DATE) AS snapshot_date,
  CASE WHEN o_orderkey % 50 = 0 THEN -o_totalprice ELSE o_totalprice END AS closing_balance
FROM {orders}""",
    "login_events": """
SELECT CAST(event_id AS STRING) AS login_id, CAST(user_id AS STRING) AS user_id,
  CAST(user_id AS STRING) AS device_id, CAST(ts AS TIMESTAMP) AS login_ts,
  event_type <> 'error' AS is_success
FROM {events}""",
    "stream_events": f"""
SELECT event_id * 2 AS seq, concat('e', CAST(event_id AS STRING)) AS transaction_id,
  CAST(user_id % 10 AS STRING) AS user_id, value AS amount, {_EVENT_TIME} AS event_time,
  CAST(ts AS TIMESTAMP) AS ingested_at
FROM {{events}}
UNION ALL
SELECT event_id * 2 + 1 AS seq, concat('e', CAST(event_id AS STRING)) AS transaction_id,
  CAST(user_id % 10 AS STRING) AS user_id, value AS amount, {_EVENT_TIME} AS event_time,
  CAST(ts + CAST(60 + event_id % 121 AS INT) * INTERVAL '1' SECOND AS TIMESTAMP) AS ingested_at
FROM {{events}} WHERE event_id % 67 = 0""",
    # Change envelopes of an order table: every order is created, failed ones change amount later,
    # low-priority ones are removed in the end. `position` is the log position.
    "change_log": """
SELECT o_orderkey * 3 AS position, 'c' AS op, CAST(o_orderkey AS STRING) AS order_id,
  CAST(o_custkey AS STRING) AS account_id, o_orderstatus AS status, o_totalprice AS amount
FROM {orders}
UNION ALL
SELECT o_orderkey * 3 + 1 AS position, 'u' AS op, CAST(o_orderkey AS STRING) AS order_id,
  CAST(o_custkey AS STRING) AS account_id, 'X' AS status, o_totalprice + 1 AS amount
FROM {orders} WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey * 3 + 2 AS position, 'd' AS op, CAST(o_orderkey AS STRING) AS order_id,
  CAST(o_custkey AS STRING) AS account_id, o_orderstatus AS status, o_totalprice AS amount
FROM {orders} WHERE o_orderpriority = '5-LOW'""",
}


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def wallet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived table `name`, with its clock columns as TIMESTAMP (watermarks need that)."""
    text = VIEWS[name]
    frames = {t: raw(spark, sf_dir, t) for t in re.findall(r"{(\w+)}", text)}
    df = spark.sql(text, **frames)
    clocks = [c for c, kind in df.dtypes if kind == "timestamp_ntz"]
    return df.withColumns({c: df[c].cast("timestamp") for c in clocks}) if clocks else df


def sql_view(name: str) -> str:
    """The same SELECT over plainly named tables, for an outside SQL engine."""
    return re.sub(r"{(\w+)}", r"\1", VIEWS[name]).strip()
