"""The SQL twin of each registered query, for DuckDB over the same Parquet tables.

Texts are put together from named building blocks: `with_views("b", ...)` prefixes a body with the
WITH clauses it needs, in order.
"""

from __future__ import annotations

from ledgerlake.sources.supplied import VIEWS, sql_view

# Named sub-selects over the wallet tables: (text, names it builds on).
BLOCKS: dict[str, tuple[str, tuple[str, ...]]] = {
    name: (sql_view(name), ()) for name in VIEWS}


def block(name: str, text: str, *needs: str) -> None:
    BLOCKS[name] = (text.strip(), needs)


def with_views(body: str, *needs: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in BLOCKS[name][1]:
                visit(other)
            ordered.append(name)

    for need in needs:
        visit(need)
    heads = ",\n".join(f"{n} AS (\n{BLOCKS[n][0]}\n)" for n in ordered)
    return f"WITH RECURSIVE {heads}\n{body.strip()}"


ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, *needs: str) -> None:
    ORACLE[name] = with_views(body, *needs) if needs else body.strip()


block("typed_transactions", """
SELECT * REPLACE (CASE WHEN channel IS NULL THEN 'UNKNOWN' ELSE lower(trim(channel)) END
  AS channel) FROM transactions""", "transactions")

block("valid_transactions", """
SELECT * FROM typed_transactions
WHERE transaction_id IS NOT NULL AND account_id IS NOT NULL AND user_id IS NOT NULL
  AND timestamp IS NOT NULL AND ingested_at IS NOT NULL
  AND amount > 0 AND old_balance >= 0 AND new_balance >= 0
  AND type IN ('deposit', 'withdraw', 'transfer', 'payment')
  AND status IN ('success', 'failed', 'pending')
  AND channel IN ('app', 'web', 'atm', 'UNKNOWN') AND currency = 'VND'""", "typed_transactions")

# Ties on ingested_at fall to the greatest remaining columns, in table order.
block("silver_transactions", """
SELECT * EXCLUDE (rn), CAST(timestamp AS DATE) AS event_date FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY ingested_at DESC NULLS LAST,
    account_id DESC NULLS LAST, user_id DESC NULLS LAST, device_id DESC NULLS LAST,
    type DESC NULLS LAST, amount DESC NULLS LAST, currency DESC NULLS LAST,
    status DESC NULLS LAST, channel DESC NULLS LAST, old_balance DESC NULLS LAST,
    new_balance DESC NULLS LAST, merchant_id DESC NULLS LAST,
    counterparty_account_id DESC NULLS LAST, timestamp DESC NULLS LAST) AS rn
  FROM valid_transactions) WHERE rn = 1""", "valid_transactions")


block("silver_snapshots", """
SELECT account_id, snapshot_date, max(closing_balance) AS closing_balance
FROM balance_snapshots
WHERE account_id IS NOT NULL AND snapshot_date IS NOT NULL AND closing_balance >= 0
GROUP BY account_id, snapshot_date""", "balance_snapshots")

block("silver_logins", """
SELECT *, CAST(login_ts AS DATE) AS login_date FROM login_events
WHERE login_id IS NOT NULL AND user_id IS NOT NULL AND device_id IS NOT NULL
  AND login_ts IS NOT NULL""", "login_events")

# --- Scans, sinks, cleaning -------------------------------------------------------------------

_SILVER = """
SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM silver_transactions"""

oracle("clean_transactions", _SILVER, "silver_transactions")
for _name in ("scan_zone", "compaction_keeps_rows", "clean_logins"):
    oracle(_name, """
SELECT * REPLACE (CAST(login_date AS VARCHAR) AS login_date) FROM silver_logins""",
           "silver_logins")
oracle("compaction_selective", """
SELECT l_returnflag, count(*) AS n, round(sum(CAST(l_extendedprice AS DOUBLE)), 2) AS total,
  count(*) FILTER (WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1995-03-31'
    AND l_extendedprice BETWEEN 0 AND 20000) AS selected,
  true AS large_kept, true AS fewer_files, true AS pruned
FROM lineitem GROUP BY l_returnflag""")
oracle("scan_pruned", "SELECT login_id FROM silver_logins", "silver_logins")
oracle("bronze_normalize", "SELECT * FROM transactions", "transactions")

_TABLES = ("users", "accounts", "merchants", "devices", "transactions", "balance_snapshots",
           "login_events")
oracle("write_verify", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS source_rows, count(*) AS target_rows FROM {t}"
    for t in _TABLES), *_TABLES)
oracle("ingest_summary", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS source_rows, count(*) AS target_rows,"
    f" CAST(NULL AS VARCHAR) AS error FROM {t}"
    for t in ("merchants", "users", "login_events")), "merchants", "users", "login_events")
oracle("partitioned_write", """
SELECT CAST(login_date AS VARCHAR) AS login_date, count(*) AS row_count,
  count(*) FILTER (WHERE is_success) AS success_count
FROM silver_logins GROUP BY ALL""", "silver_logins")
oracle("partition_prune", """
SELECT is_success, count(*) AS row_count, count(DISTINCT user_id) AS user_count
FROM silver_logins WHERE login_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'
GROUP BY is_success""", "silver_logins")
oracle("schema_merge", """
SELECT CASE WHEN channel IS NULL THEN 'old' ELSE 'new' END AS era, channel,
  count(*) AS row_count FROM transactions GROUP BY 1, 2""", "transactions")
oracle("catalog_register", "SELECT count(*) AS catalog_rows FROM silver_logins", "silver_logins")
oracle("layout_rows", """
SELECT 'silver.login_events' AS table_name, count(*) AS row_count FROM silver_logins""",
       "silver_logins")

for _name in ("users", "accounts", "merchants", "devices"):
    oracle(f"clean_{_name}", f"SELECT * FROM {_name}", _name)
    oracle(f"dim_{_name[:-1]}", f"SELECT * FROM {_name}", _name)
oracle("clean_snapshots", """
SELECT * REPLACE (CAST(snapshot_date AS VARCHAR) AS snapshot_date) FROM silver_snapshots""",
       "silver_snapshots")
oracle("ensure_column", """
SELECT 'UNKNOWN' AS channel, count(*) AS row_count FROM transactions""", "transactions")
oracle("normalize_channel", """
SELECT channel, count(*) AS row_count FROM typed_transactions GROUP BY channel""",
       "typed_transactions")
oracle("domain_filter", """
SELECT type, status, channel, currency, count(*) AS row_count FROM typed_transactions
WHERE type IN ('deposit', 'withdraw', 'transfer', 'payment')
  AND status IN ('success', 'failed', 'pending')
  AND channel IN ('app', 'web', 'atm', 'UNKNOWN') AND currency = 'VND'
GROUP BY ALL""", "typed_transactions")
oracle("balance_rule", """
SELECT status, count(*) AS row_count, count(*) FILTER (WHERE CASE
  WHEN type = 'deposit' THEN abs(new_balance - (old_balance + amount)) < 1e-6
  WHEN type IN ('withdraw', 'transfer', 'payment')
    THEN abs(new_balance - (old_balance - amount)) < 1e-6
  ELSE true END) AS consistent_rows
FROM transactions GROUP BY status""", "transactions")
oracle("dedup_latest", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY ingested_at DESC NULLS LAST,
    account_id DESC NULLS LAST, user_id DESC NULLS LAST, device_id DESC NULLS LAST,
    type DESC NULLS LAST, amount DESC NULLS LAST, currency DESC NULLS LAST,
    status DESC NULLS LAST, channel DESC NULLS LAST, old_balance DESC NULLS LAST,
    new_balance DESC NULLS LAST, merchant_id DESC NULLS LAST,
    counterparty_account_id DESC NULLS LAST, timestamp DESC NULLS LAST) AS rn
  FROM transactions) WHERE rn = 1""", "transactions")
oracle("dedup_any", """
SELECT account_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
  max(closing_balance) AS closing_balance
FROM balance_snapshots GROUP BY account_id, snapshot_date""", "balance_snapshots")
oracle("dedup_any_keys", """
SELECT DISTINCT account_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date
FROM balance_snapshots""", "balance_snapshots")
oracle("dup_stats", """
SELECT count(*) AS total_rows, count(DISTINCT transaction_id) AS distinct_keys,
  count(*) - count(DISTINCT transaction_id) AS duplicate_rows,
  (count(*) - count(DISTINCT transaction_id)) / count(*) AS duplicate_rate
FROM transactions""", "transactions")
oracle("unique_key_violations", """
SELECT transaction_id, count(*) AS row_count FROM transactions
GROUP BY transaction_id HAVING count(*) > 1""", "transactions")

# --- Gold model -------------------------------------------------------------------------------

block("dates", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date,
  CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
  dayname(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT event_date AS d FROM silver_transactions
  UNION SELECT login_date FROM silver_logins UNION SELECT snapshot_date FROM silver_snapshots)
WHERE d IS NOT NULL""", "silver_transactions", "silver_logins", "silver_snapshots")

block("fact_tx", """
SELECT transaction_id, user_id, account_id, merchant_id, device_id, counterparty_account_id,
  CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS date_key, type, status, channel, currency,
  amount, old_balance, new_balance, timestamp, ingested_at, event_date
FROM silver_transactions""", "silver_transactions")

block("wide", """
SELECT transaction_id, user_id, kyc_verified, u.created_at AS user_created_at, account_id,
  account_type, a.currency AS account_currency, a.created_at AS account_created_at, device_id,
  device_type, os, first_seen_at, merchant_id, merchant_name, category AS merchant_category,
  date_key, day_of_week, month, quarter, year, is_weekend, f.type, f.status, f.channel,
  f.currency, amount, old_balance, new_balance, counterparty_account_id, timestamp, ingested_at,
  event_date
FROM fact_tx f LEFT JOIN users u USING (user_id) LEFT JOIN accounts a USING (account_id)
LEFT JOIN devices d USING (device_id) LEFT JOIN merchants m USING (merchant_id)
LEFT JOIN dates USING (date_key)""", "fact_tx", "users", "accounts", "devices", "merchants",
      "dates")

oracle("dim_date", """
SELECT * REPLACE (CAST(calendar_date AS VARCHAR) AS calendar_date) FROM dates""", "dates")
oracle("fact_transactions", """
SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM fact_tx""", "fact_tx")
oracle("fact_logins", """
SELECT login_id, user_id, device_id, CAST(strftime(login_date, '%Y%m%d') AS INTEGER) AS date_key,
  is_success, login_ts, CAST(login_date AS VARCHAR) AS event_date FROM silver_logins""",
       "silver_logins")
oracle("fact_snapshots", """
SELECT account_id, CAST(strftime(snapshot_date, '%Y%m%d') AS INTEGER) AS date_key,
  CAST(snapshot_date AS VARCHAR) AS snapshot_date, closing_balance FROM silver_snapshots""",
       "silver_snapshots")
oracle("obt", "SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM wide", "wide")

# --- Features and merchants -------------------------------------------------------------------

# Averages are cent-exact totals divided by counts, as in the registered queries.
block("offline_features", """
SELECT user_id, coalesce(n, 0) AS f_user_total_transactions_90d,
  coalesce(total / n, 0.0) AS f_user_avg_transaction_amount_90d,
  coalesce(failed / n, 0.0) AS f_user_failed_transaction_rate_90d,
  coalesce(merchants, 0) AS f_user_distinct_merchants_90d,
  (SELECT max(timestamp) FROM silver_transactions) AS event_timestamp
FROM users LEFT JOIN (
  SELECT user_id, count(*) AS n, round(sum(amount), 2) AS total,
    count(*) FILTER (WHERE status = 'failed') AS failed, count(DISTINCT merchant_id) AS merchants
  FROM silver_transactions
  WHERE timestamp >= (SELECT max(timestamp) - INTERVAL 90 DAY FROM silver_transactions)
  GROUP BY user_id) USING (user_id)""", "silver_transactions", "users")
for _name in ("feat_user_90d", "feat_user_90d_incremental"):
    oracle(_name, "SELECT * FROM offline_features", "offline_features")

block("merchant_metrics", """
SELECT merchant_id, count(*) AS n, round(sum(amount), 2) AS total,
  count(*) FILTER (WHERE status = 'success') AS ok,
  count(*) FILTER (WHERE status = 'failed') AS failed,
  count(DISTINCT user_id) AS users
FROM silver_transactions WHERE merchant_id IS NOT NULL GROUP BY merchant_id""",
      "silver_transactions")
block("merchant_table", """
SELECT merchant_id, merchant_name, category, coalesce(n, 0) AS transaction_count,
  coalesce(total, 0.0) AS total_amount, coalesce(total / n, 0.0) AS avg_amount,
  coalesce(ok, 0) AS success_count, coalesce(failed, 0) AS failed_count,
  coalesce(users, 0) AS distinct_users
FROM merchants LEFT JOIN merchant_metrics USING (merchant_id)""", "merchants", "merchant_metrics")
oracle("merchant_performance", "SELECT * FROM merchant_table", "merchant_table")

block("workload", """
SELECT merchant_id, merchant_name, category, count(amount) AS transaction_count,
  coalesce(round(sum(amount), 2), 0.0) AS total_amount,
  coalesce(round(sum(amount), 2) / count(amount), 0.0) AS avg_amount,
  count(*) FILTER (WHERE status = 'success') AS success_count,
  count(*) FILTER (WHERE status = 'failed') AS failed_count
FROM merchants LEFT JOIN (SELECT merchant_id, amount, status FROM transactions)
  USING (merchant_id)
GROUP BY merchant_id, merchant_name, category""", "merchants", "transactions")
for _name in ("merchant_workload", "merchant_workload_salted", "merchant_workload_join_first"):
    oracle(_name, "SELECT * FROM workload", "workload")
oracle("control_totals", """
SELECT count(*) AS result_rows, CAST(sum(transaction_count) AS BIGINT) AS transactions,
  round(sum(total_amount), 2) AS total_amount, CAST(sum(success_count) AS BIGINT) AS success,
  CAST(sum(failed_count) AS BIGINT) AS failed
FROM workload""", "workload")
oracle("conditional_counts", """
SELECT type, count(*) FILTER (WHERE status = 'success') AS success_count,
  count(*) FILTER (WHERE status = 'failed') AS failed_count,
  count(*) FILTER (WHERE status = 'pending') AS pending_count
FROM transactions GROUP BY type""", "transactions")
oracle("merchant_skew_profile", """
SELECT CAST(sum(c) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
  CAST(max(k) AS BIGINT) AS top_keys,
  CAST(sum(c) FILTER (WHERE r <= k) AS BIGINT) / CAST(sum(c) AS BIGINT) * 100 AS top_share_pct,
  max(c) AS max_rows, min(c) AS min_rows, CAST(sum(c) AS BIGINT) / count(*) AS mean_rows,
  median(c) AS median_rows, max(c) / median(c) AS max_median_ratio
FROM (SELECT c, row_number() OVER (ORDER BY c DESC, merchant_id) AS r,
    greatest(1, ceil(count(*) OVER () * CAST(0.05 AS DOUBLE))) AS k
  FROM (SELECT merchant_id, count(*) AS c FROM transactions WHERE merchant_id IS NOT NULL
    GROUP BY merchant_id))""", "transactions")
oracle("top_merchants", """
SELECT merchant_id, count(*) AS transaction_count FROM transactions
WHERE merchant_id IS NOT NULL GROUP BY merchant_id
ORDER BY transaction_count DESC, merchant_id LIMIT 10""", "transactions")
oracle("top_share", """
SELECT count(*) AS row_count, avg(CAST(CAST(merchant_id IS NOT NULL AND merchant_id IN (
  SELECT merchant_id FROM (
    SELECT merchant_id, row_number() OVER (ORDER BY count(*) DESC, merchant_id) AS r,
      greatest(1, ceil(count(*) OVER () * CAST(0.05 AS DOUBLE))) AS k
    FROM transactions WHERE type = 'payment' AND merchant_id IS NOT NULL GROUP BY merchant_id)
  WHERE r <= k) AS INTEGER) AS DOUBLE)) AS member_rate
FROM transactions WHERE type = 'payment'""", "transactions")

oracle("top_share_members", """
SELECT l_orderkey FROM (SELECT l_orderkey, row_number() OVER (ORDER BY count(*) DESC, l_orderkey) AS r,
    greatest(1, ceil(count(*) OVER () * CAST(0.05 AS DOUBLE))) AS k FROM lineitem GROUP BY l_orderkey)
WHERE r <= k""")

# --- Profiles ---------------------------------------------------------------------------------

oracle("distinct_exact", """
SELECT count(DISTINCT transaction_id) AS distinct_transaction_ids FROM transactions""",
       "transactions")
oracle("distinct_error_bound", """
SELECT count(DISTINCT transaction_id) AS exact_count, true AS within_bound FROM transactions""",
       "transactions")
oracle("cardinality_within_bound", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS exact_distinct, true AS within_bound"
    f" FROM transactions" for c in ("transaction_id", "account_id", "merchant_id", "type")),
       "transactions")

oracle("cardinality_incremental", " UNION ALL ".join(
    f"SELECT '{days}' AS days, '{c}' AS column_name, count(DISTINCT {c}) AS exact_distinct,"
    f" true AS within_bound, {once} AS as_one_pass FROM transactions WHERE {rows}"
    for days, once, rows in (("all", "true", "true"),
                             ("1995", "NULL::BOOLEAN", "year(timestamp) = 1995"))
    for c in ("transaction_id", "account_id", "merchant_id", "type")),
       "transactions")


def _removed(table: str, cleaned: str) -> str:
    return (f"SELECT '{table}' AS table_name, b AS bronze_rows, s AS silver_rows,"
            f" b - s AS removed_rows FROM (SELECT (SELECT count(*) FROM {table}) AS b,"
            f" (SELECT count(*) FROM {cleaned}) AS s)")


_CLEANED = {"users": "users", "accounts": "accounts", "merchants": "merchants",
            "devices": "devices", "transactions": "silver_transactions",
            "balance_snapshots": "silver_snapshots", "login_events": "silver_logins"}
_ZONES = (*_TABLES, "silver_transactions", "silver_snapshots", "silver_logins")
oracle("table_quality", " UNION ALL ".join(_removed(*pair) for pair in _CLEANED.items()), *_ZONES)

for _name, _expr, _out in (("hour_skew", "CAST(hour(timestamp) AS INTEGER)", "hour"),
                           ("channel_skew", "channel", "channel"),
                           ("status_mix", "status", "status")):
    oracle(_name, f"""
SELECT {_out}, row_count, row_count / CAST(sum(row_count) OVER () AS BIGINT) AS share
FROM (SELECT {_expr} AS {_out}, count(*) AS row_count FROM transactions GROUP BY 1)
WHERE {_out} IS NOT NULL""", "transactions")
oracle("null_rates", "SELECT " + ", ".join(
    f"avg(CAST(CAST({c} IS NULL AS INTEGER) AS DOUBLE)) AS {c}_null_rate"
    for c in ("merchant_id", "counterparty_account_id", "channel")) + " FROM transactions",
       "transactions")
oracle("failed_rule_rates", """
SELECT avg(CAST(CAST(new_balance = old_balance AS INTEGER) AS DOUBLE))
    FILTER (WHERE status = 'failed') AS failed_balance_kept_rate,
  avg(CAST(CAST(status = 'failed' AS INTEGER) AS DOUBLE))
    FILTER (WHERE type <> 'deposit' AND amount > old_balance) AS overdrawn_failed_rate
FROM transactions""", "transactions")
oracle("closing_balance", """
SELECT account_id, CAST(day AS VARCHAR) AS snapshot_date, new_balance AS closing_balance FROM (
  SELECT account_id, CAST(timestamp AS DATE) AS day, new_balance, row_number() OVER (
    PARTITION BY account_id, CAST(timestamp AS DATE)
    ORDER BY timestamp DESC, ingested_at DESC, transaction_id DESC, new_balance DESC) AS rn
  FROM transactions) WHERE rn = 1""", "transactions")
oracle("latest_balance", """
SELECT account_id, user_id, coalesce(closing_balance, 0.0) AS balance
FROM accounts LEFT JOIN (
  SELECT account_id, closing_balance, row_number() OVER (PARTITION BY account_id
    ORDER BY snapshot_date DESC, closing_balance DESC) AS rn FROM balance_snapshots) s
  ON s.account_id = accounts.account_id AND rn = 1""".replace(
    "SELECT account_id, user_id,", "SELECT accounts.account_id, user_id,"),
       "accounts", "balance_snapshots")
oracle("devices_by_user", """
SELECT user_id, n // 10000 AS part, list(device_id ORDER BY n) AS device_ids FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY device_id) - 1 AS n FROM devices)
GROUP BY user_id, n // 10000""", "devices")
oracle("logins_by_user", """
SELECT user_id, n // 10000 AS part, list(login_id ORDER BY n) AS login_ids FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY login_id) - 1 AS n FROM login_events)
GROUP BY user_id, n // 10000""", "login_events")
block("per_minute", """
SELECT date_trunc('minute', ingested_at) AS minute, count(*) AS event_count
FROM stream_events GROUP BY 1""", "stream_events")
oracle("events_per_minute", "SELECT * FROM per_minute", "per_minute")
oracle("minutes_between", """
SELECT * FROM per_minute WHERE CAST(minute AS DATE) = DATE '2024-01-02'
  AND strftime(minute, '%H:%M') BETWEEN '17:15' AND '17:45'""", "per_minute")
oracle("late_rate", """
SELECT count(*) AS row_count,
  avg(CAST(CAST(ingested_at > event_time AS INTEGER) AS DOUBLE)) AS late_rate
FROM stream_events""", "stream_events")
oracle("freshness", " UNION ALL ".join(f"""
SELECT '{name}' AS component, newest_event, round(lag, 3) AS lag_minutes,
  {target} AS target_minutes, lag <= {target} AS fresh
FROM (SELECT max({clock}) AS newest_event, (epoch_us(TIMESTAMP '2024-02-01 00:00:00')
  - epoch_us(max({clock}))) / 60000000 AS lag FROM {table})"""
    for name, table, clock, target in (("offline", "transactions", "timestamp", 60),
                                       ("unified", "login_events", "login_ts", 15),
                                       ("streaming", "stream_events", "event_time", 5))),
       "transactions", "login_events", "stream_events")

# --- Quality ----------------------------------------------------------------------------------


def rule(name: str, count: str, expected: str, passes: str = "n = 0") -> str:
    return (f"SELECT '{name}' AS rule_name, {passes} AS passed, CAST(n AS VARCHAR) AS actual_value,"
            f" '{expected}' AS expected FROM (SELECT ({count}) AS n)")


def where(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


def filled(name: str, table: str) -> str:
    return rule(f"{name}.non_empty", f"SELECT count(*) FROM {table}", "row_count > 0", "n > 0")


def repeated(name: str, table: str, key: str, gold: bool = False) -> str:
    title = f"{name}.unique_key({key})" if gold else f"{name}.duplicate_key"
    return rule(title, f"SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {key}"
                       f" HAVING count(*) > 1)", "0 duplicate key groups")


def nulls(name: str, table: str, columns: str, gold: bool = False) -> str:
    broken = " OR ".join(f"{c} IS NULL" for c in columns.split(","))
    return rule(f"{name}.required_columns_not_null" if gold else f"{name}.null_key",
                where(table, broken),
                "0 NULL required rows" if gold else "0 null-key rows")


def negatives(name: str, table: str, columns: str) -> str:
    return rule(f"{name}.non_negative_metrics",
                where(table, " OR ".join(f"{c} < 0" for c in columns.split(","))),
                "0 negative metric rows")


def equal_counts(name: str, left: str, right: str) -> str:
    return (f"SELECT '{name}' AS rule_name, l = r AS passed, concat(l, ' vs ', r) AS actual_value,"
            f" 'row counts must be equal' AS expected FROM (SELECT"
            f" (SELECT count(*) FROM {left}) AS l, (SELECT count(*) FROM {right}) AS r)")


def orphans(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return rule(name, f"SELECT count(DISTINCT {key}) FROM {child} WHERE {key} NOT IN"
                      f" (SELECT {parent_key} FROM {parent})", "0 orphan keys")


def transaction_rules(table: str) -> list[str]:
    t = "transactions"
    return [
        filled(t, table), nulls(t, table, "transaction_id,account_id,user_id"),
        repeated(t, table, "transaction_id"),
        rule(f"{t}.channel_not_null", where(table, "channel IS NULL"), "0 NULL channel rows"),
        rule(f"{t}.valid_amount", where(table, "amount <= 0"), "0 rows with amount <= 0"),
        rule(f"{t}.valid_balance", where(table, "old_balance < 0 OR new_balance < 0"),
             "0 negative balance rows"),
        rule(f"{t}.valid_type", where(
            table, "type NOT IN ('deposit', 'withdraw', 'transfer', 'payment')"),
             "0 invalid transaction types"),
        rule(f"{t}.valid_status", where(table, "status NOT IN ('success', 'failed', 'pending')"),
             "0 invalid transaction status rows")]


def together(rules: list[str]) -> str:
    return "\nUNION ALL ".join(rules)


oracle("dq_non_empty", filled("login_events", "login_events"), "login_events")
oracle("dq_null_keys", nulls("transactions", "transactions", "merchant_id,channel"),
       "transactions")
oracle("dq_unique", repeated("balance_snapshots", "balance_snapshots", "account_id, snapshot_date"),
       "balance_snapshots")
oracle("dq_non_negative", negatives(
    "fact_transactions", "transactions", "amount,old_balance,new_balance"), "transactions")
oracle("dq_domain", together(transaction_rules("transactions")), "transactions")
_RATE = rule("feat_user_90d.failed_transaction_rate_between_0_and_1", where(
    "offline_features", "f_user_failed_transaction_rate_90d IS NULL"
    " OR f_user_failed_transaction_rate_90d < 0 OR f_user_failed_transaction_rate_90d > 1"),
             "0 invalid rate rows")
oracle("dq_rate", _RATE, "offline_features")

_FACTS = {"transactions": "fact_transactions", "login_events": "fact_login_events",
          "balance_snapshots": "fact_balance_snapshot"}
_CONTRACTS = [
    equal_counts(f"silver.{t}_count_equals_{_FACTS.get(t, 'dim_' + t[:-1])}_count", c, c)
    for t, c in _CLEANED.items()]
oracle("dq_row_counts", together(_CONTRACTS), *_ZONES)
oracle("dq_row_counts_raw", together([
    equal_counts(f"{t}_count_equals_silver_{t}_count", t, c) for t, c in _CLEANED.items()]),
       *_ZONES)
oracle("fk_orphans", """
SELECT DISTINCT merchant_id AS orphan FROM transactions WHERE merchant_id IS NOT NULL
  AND merchant_id NOT IN (SELECT merchant_id FROM merchants WHERE category <> 'grocery')""",
       "transactions", "merchants")
oracle("dq_foreign_key", orphans(
    "transactions.counterparty_account_id_exists_in_accounts", "transactions",
    "counterparty_account_id", "accounts", "account_id"), "transactions", "accounts")


def keyed(name: str, table: str, key: str, required: str) -> list[str]:
    return [filled(name, table), nulls(name, table, required), repeated(name, table, key)]


oracle("dq_silver", together([
    *keyed("users", "users", "user_id", "user_id"),
    *keyed("accounts", "accounts", "account_id", "account_id,user_id"),
    *keyed("merchants", "merchants", "merchant_id", "merchant_id"),
    *keyed("devices", "devices", "device_id", "device_id,user_id"),
    *transaction_rules("silver_transactions"),
    *keyed("balance_snapshots", "silver_snapshots", "account_id, snapshot_date",
           "account_id,snapshot_date"),
    rule("balance_snapshots.valid_balance", where("silver_snapshots", "closing_balance < 0"),
         "0 negative closing_balance rows"),
    *keyed("login_events", "silver_logins", "login_id", "login_id,user_id,device_id"),
]), *_ZONES)


def gold_keyed(name: str, table: str, key: str, required: str) -> list[str]:
    return [filled(name, table), nulls(name, table, required, gold=True),
            repeated(name, table, key, gold=True)]


block("fact_login", """
SELECT login_id, user_id, device_id, CAST(strftime(login_date, '%Y%m%d') AS INTEGER) AS date_key,
  login_ts, login_date AS event_date FROM silver_logins""", "silver_logins")
block("fact_snapshot", """
SELECT account_id, CAST(strftime(snapshot_date, '%Y%m%d') AS INTEGER) AS date_key, snapshot_date,
  closing_balance FROM silver_snapshots""", "silver_snapshots")

_MONEY = "amount,old_balance,new_balance"
oracle("dq_gold", together([
    *gold_keyed("dim_user", "users", "user_id", "user_id"),
    *gold_keyed("dim_account", "accounts", "account_id", "account_id"),
    *gold_keyed("dim_merchant", "merchants", "merchant_id", "merchant_id"),
    *gold_keyed("dim_device", "devices", "device_id", "device_id"),
    *gold_keyed("dim_date", "dates", "date_key", "date_key"),
    *gold_keyed("fact_transactions", "fact_tx", "transaction_id",
                "transaction_id,user_id,account_id,date_key,event_date,timestamp"),
    negatives("fact_transactions", "fact_tx", _MONEY),
    *gold_keyed("fact_login_events", "fact_login", "login_id",
                "login_id,user_id,device_id,date_key,login_ts,event_date"),
    *gold_keyed("fact_balance_snapshot", "fact_snapshot", "account_id,snapshot_date",
                "account_id,date_key,snapshot_date,closing_balance"),
    negatives("fact_balance_snapshot", "fact_snapshot", "closing_balance"),
    *gold_keyed("obt_transaction_enriched", "wide", "transaction_id",
                "transaction_id,user_id,account_id,date_key,timestamp,event_date"),
    negatives("obt_transaction_enriched", "wide", _MONEY),
    *gold_keyed("feat_user_90d", "offline_features", "user_id", "user_id,event_timestamp"),
    negatives("feat_user_90d", "offline_features",
              "f_user_total_transactions_90d,f_user_avg_transaction_amount_90d,"
              "f_user_distinct_merchants_90d"),
    _RATE,
    *gold_keyed("opt_merchant_performance", "merchant_table", "merchant_id", "merchant_id"),
    negatives("opt_merchant_performance", "merchant_table",
              "transaction_count,total_amount,avg_amount,success_count,failed_count,"
              "distinct_users"),
    *_CONTRACTS,
    equal_counts("fact_transactions_count_equals_obt_transaction_enriched_count", "fact_tx",
                 "wide"),
    equal_counts("dim_user_count_equals_feat_user_90d_count", "users", "offline_features"),
    equal_counts("dim_merchant_count_equals_opt_merchant_performance_count", "merchants",
                 "merchant_table"),
    *[orphans(f"{f}.date_key_exists_in_dim_date", t, "date_key", "dates", "date_key")
      for f, t in (("fact_transactions", "fact_tx"), ("fact_login_events", "fact_login"),
                   ("fact_balance_snapshot", "fact_snapshot"))],
]), *_ZONES, "fact_tx", "fact_login", "fact_snapshot", "dates", "wide", "offline_features",
       "merchant_table")
oracle("dq_gate", together([
    filled("transactions", "silver_transactions"),
    nulls("transactions", "silver_transactions", "transaction_id"),
    repeated("transactions", "silver_transactions", "transaction_id"),
    rule("transactions.channel_not_null", where("silver_transactions", "channel IS NULL"),
         "0 NULL channel rows")]), "silver_transactions")

# --- Streams ----------------------------------------------------------------------------------

# First sights: the first arrival of an id, then the first one more than 30 minutes after that,
# and so on.
block("first_sights", """
SELECT transaction_id, min({'at': ingested_at, 'seq': seq}) AS sight
FROM stream_events GROUP BY transaction_id
UNION ALL
SELECT e.transaction_id, min({'at': e.ingested_at, 'seq': e.seq})
FROM first_sights s JOIN stream_events e ON e.transaction_id = s.transaction_id
  AND e.ingested_at > s.sight.at + INTERVAL 30 MINUTE
GROUP BY e.transaction_id""", "stream_events")
block("marked", """
SELECT e.*, s.transaction_id IS NULL AS is_duplicate FROM stream_events e
LEFT JOIN first_sights s ON s.transaction_id = e.transaction_id AND s.sight.seq = e.seq""",
      "first_sights")
block("unique_events", "SELECT * EXCLUDE (is_duplicate) FROM marked WHERE NOT is_duplicate",
      "marked")
# Late by definition: some earlier arrival's event time lies 70 s or more past the window's end.
block("judged", """
SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
  coalesce(max(event_time) OVER (ORDER BY ingested_at, seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    >= time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 370 SECOND, false) AS is_late
FROM unique_events""", "unique_events")
block("stream_windows", """
SELECT user_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS count,
  round(sum(amount), 2) AS total_amount
FROM judged WHERE NOT is_late GROUP BY user_id, window_start""", "judged")
block("bursts", """
SELECT time_bucket(INTERVAL 10 SECOND, ingested_at) AS window_start,
  time_bucket(INTERVAL 10 SECOND, ingested_at) + INTERVAL 10 SECOND AS window_end,
  count(*) AS event_count, count(*) >= 2 AS burst_detected
FROM stream_events GROUP BY 1, 2""", "stream_events")
oracle("stream_raw", """
SELECT count(*) AS row_count, count(DISTINCT seq) AS distinct_messages FROM stream_events""",
       "stream_events")
oracle("stream_parse", "SELECT * FROM stream_events", "stream_events")
oracle("stream_quarantine", "SELECT count(*) AS row_count FROM stream_events", "stream_events")
oracle("stream_dedup", "SELECT * FROM unique_events", "unique_events")
oracle("stream_duplicates", "SELECT * EXCLUDE (is_duplicate) FROM marked WHERE is_duplicate",
       "marked")
oracle("stream_dedup_live", "SELECT transaction_id, seq, is_duplicate FROM marked", "marked")
oracle("stream_late", "SELECT * EXCLUDE (is_late, window_start) FROM judged WHERE is_late",
       "judged")
# at every arrival, and whenever a partition falls idle, the least of the partitions that are not
block("dealt", """
SELECT * REPLACE (CASE WHEN n = 2 THEN event_time - INTERVAL 25 MINUTE ELSE event_time END AS event_time),
  'p' || n AS partition FROM (SELECT *, CASE WHEN seq % 4 = 3 AND ingested_at >= TIMESTAMP '2024-01-08'
    THEN 0 ELSE seq % 4 END AS n FROM stream_events)""", "stream_events")
block("source_progress", """
SELECT partition, ingested_at AS instant, seq::HUGEINT AS seq, max(event_time) OVER o AS newest, ingested_at AS last_at
FROM dealt WINDOW o AS (PARTITION BY partition ORDER BY ingested_at, seq)""", "dealt")
block("moments", """
SELECT instant, seq, (epoch_us(instant)::HUGEINT << 64) + seq AS key, false AS idle FROM source_progress
UNION ALL SELECT DISTINCT instant + INTERVAL 20 MINUTE, 1::HUGEINT << 63,
  (epoch_us(instant + INTERVAL 20 MINUTE)::HUGEINT << 64) + (1::HUGEINT << 63), true FROM source_progress
WHERE instant + INTERVAL 20 MINUTE < (SELECT max(instant) FROM source_progress)""", "source_progress")
block("watermark", """
SELECT key, max(least_newest) OVER (ORDER BY key) AS mark FROM (
  SELECT key, min(newest) AS least_newest FROM (
    SELECT m.key, p.newest FROM (SELECT m.*, partition FROM moments m, (SELECT DISTINCT partition FROM dealt)) m
    ASOF JOIN (SELECT *, (epoch_us(instant)::HUGEINT << 64) + seq AS key FROM source_progress) p
      ON p.partition = m.partition AND m.key >= p.key
    WHERE CASE WHEN m.idle THEN p.last_at + INTERVAL 20 MINUTE > m.instant ELSE p.last_at + INTERVAL 20 MINUTE >= m.instant END)
  GROUP BY key)""", "moments")
_LATE_BY_SOURCE = """
SELECT d.* EXCLUDE (key, n) FROM (SELECT *, (epoch_us(ingested_at)::HUGEINT << 64) + seq AS key FROM dealt) d
ASOF JOIN watermark w ON d.key > w.key
WHERE w.mark >= time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 370 SECOND"""
for _name in ("stream_late_partitions", "stream_late_partitions_live"):
    oracle(_name, _LATE_BY_SOURCE, "watermark")
block("topic", """
SELECT (seq % 3)::VARCHAR AS partition, seq // 3 AS position, ingested_at AS arrived_at, transaction_id
FROM stream_events""", "stream_events")
oracle("topic_bounded", """
SELECT * FROM topic WHERE position >= CASE partition WHEN '0' THEN 100 WHEN '2' THEN 7 ELSE 0 END
  AND (partition <> '1' OR position < 500)""", "topic")
oracle("topic_resume", "SELECT * FROM topic", "topic")
oracle("stream_features", "SELECT * FROM stream_windows", "stream_windows")
oracle("stream_features_live", "SELECT * FROM stream_windows", "stream_windows")
oracle("burst_monitor", "SELECT * FROM bursts", "bursts")
oracle("burst_monitor_live", "SELECT * FROM bursts", "bursts")
oracle("stream_job", """
SELECT 'unique' AS output, count(*) AS row_count, NULL::DOUBLE AS total FROM unique_events
UNION ALL SELECT 'duplicate', count(*), NULL FROM marked WHERE is_duplicate
UNION ALL SELECT 'late', count(*), NULL FROM judged WHERE is_late
UNION ALL SELECT 'features', (SELECT count(*) FROM stream_windows), round(sum(amount), 1)
  FROM judged WHERE NOT is_late
UNION ALL SELECT 'feature_events', count(*), NULL FROM judged WHERE NOT is_late
UNION ALL SELECT 'burst', count(*), NULL FROM bursts WHERE burst_detected
UNION ALL SELECT 'quarantine', count(*), NULL FROM (
  SELECT (epoch_us(ingested_at) - min(epoch_us(ingested_at)) OVER ()) * 5
    // (max(epoch_us(ingested_at)) OVER () - min(epoch_us(ingested_at)) OVER () + 1) AS round
  FROM stream_events) WHERE round = 1""",
       "unique_events", "judged", "stream_windows", "bursts", "stream_events")
oracle("stream_dedup_identical", """
SELECT transaction_id, copy > 0 AS is_duplicate FROM stream_events, range(3) c(copy)
WHERE seq % 2 = 0 AND (copy = 0 OR seq % 134 = 0)""", "stream_events")
block("folded", "SELECT * REPLACE ('k' || (seq % 40)::VARCHAR AS transaction_id) FROM stream_events",
      "stream_events")
block("folded_sights", """
SELECT transaction_id, min({'at': ingested_at, 'seq': seq}) AS sight
FROM folded GROUP BY transaction_id
UNION ALL
SELECT e.transaction_id, min({'at': e.ingested_at, 'seq': e.seq})
FROM folded_sights s JOIN folded e ON e.transaction_id = s.transaction_id
  AND e.ingested_at > s.sight.at + INTERVAL 30 MINUTE
GROUP BY e.transaction_id""", "folded")
oracle("stream_dedup_long", """
SELECT e.transaction_id, e.seq, s.transaction_id IS NULL AS is_duplicate FROM folded e
LEFT JOIN folded_sights s ON s.transaction_id = e.transaction_id AND s.sight.seq = e.seq""",
       "folded_sights")
oracle("stream_refinements_live", "SELECT * FROM stream_windows", "stream_windows")


def event_text(tag: str, table: str, condition: str) -> str:
    return (f"SELECT '{tag}', printf('{tag} | transaction_id=%s | user_id=%s | amount=%.2f |"
            f" event_time=%s', transaction_id, user_id, amount,"
            f" strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f')) FROM {table} WHERE {condition}")


oracle("tagged_output", f"""
SELECT 'FEATURE' AS tag, printf('user_id=%s | window=%s -> %s | count=%d | amount=%.2f', user_id,
  strftime(window_start, '%Y-%m-%dT%H:%M:%S'), strftime(window_end, '%Y-%m-%dT%H:%M:%S'),
  count, total_amount) AS line FROM stream_windows
UNION ALL SELECT 'BURST', printf('(%d,%d,%d,%s)', epoch_ms(window_start), epoch_ms(window_end),
  event_count, CAST(burst_detected AS VARCHAR)) FROM bursts
UNION ALL {event_text('DUPLICATE', 'marked', 'is_duplicate')}
UNION ALL {event_text('LATE', 'judged', 'is_late')}""", "stream_windows", "bursts")

block("burst_features", """
SELECT user_id, window_start + INTERVAL 5 MINUTE AS event_timestamp,
  count(*) AS f_stream_transaction_count_5m, round(sum(amount), 2) AS f_stream_total_amount_5m,
  bool_or(burst_detected) AS f_stream_burst_activity_flag
FROM judged JOIN (SELECT window_start AS arrival, burst_detected FROM bursts)
  ON arrival = time_bucket(INTERVAL 10 SECOND, ingested_at)
WHERE NOT is_late GROUP BY user_id, window_start""", "judged", "bursts")
oracle("feat_stream_5m", "SELECT * FROM burst_features", "burst_features")
oracle("feat_user_unified", """
SELECT o.*, s.event_timestamp AS stream_event_timestamp, f_stream_transaction_count_5m,
  f_stream_total_amount_5m, f_stream_burst_activity_flag
FROM offline_features o LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC) AS rn
  FROM burst_features) s ON s.user_id = o.user_id AND rn = 1""",
       "offline_features", "burst_features")
oracle("point_in_time", """
SELECT l.seq, l.user_id, l.ingested_at AS label_time, w.window_end AS feature_time, w.count,
  w.total_amount
FROM stream_events l ASOF LEFT JOIN stream_windows w
  ON w.user_id = l.user_id AND l.ingested_at >= w.window_end""",
       "stream_events", "stream_windows")

# --- Changes ----------------------------------------------------------------------------------

oracle("upsert", """
SELECT transaction_id, ingested_at, status, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
    ORDER BY ingested_at DESC, fresh DESC, status DESC, amount DESC) AS rn
  FROM (
    SELECT transaction_id, ingested_at, status, amount, 0 AS fresh FROM silver_transactions
    UNION ALL
    SELECT transaction_id, ingested_at, 'reversed', amount, 1 FROM (
      SELECT *, row_number() OVER (PARTITION BY transaction_id
        ORDER BY ingested_at DESC, amount DESC) AS newest
      FROM transactions WHERE status = 'failed') WHERE newest = 1))
WHERE rn = 1""", "silver_transactions", "transactions")
oracle("upsert_partitions", """
SELECT transaction_id, ingested_at,
  CASE WHEN event_date BETWEEN DATE '1997-01-01' AND DATE '1997-03-31' THEN 'reviewed'
    ELSE status END AS status,
  amount, strftime(event_date, '%Y-%m') AS event_month
FROM silver_transactions""", "silver_transactions")
oracle("cdc_apply", """
SELECT order_id, account_id, status, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY position DESC) AS rn
  FROM change_log) WHERE rn = 1 AND op <> 'd'""", "change_log")
block("decoded", """
SELECT * REPLACE (CASE WHEN position % 2 = 0 THEN amount ELSE -amount END AS amount) FROM change_log""",
      "change_log")
oracle("cdc_encoded", """
SELECT order_id, account_id, status, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY position DESC) AS rn
  FROM decoded) WHERE rn = 1 AND op <> 'd'""", "decoded")
oracle("cdc_quarantine", """
SELECT 'quarantine' AS output, count(*) AS row_count FROM change_log WHERE position % 5 = 0
UNION ALL SELECT 'applied', count(*) FROM (
  SELECT op, row_number() OVER (PARTITION BY order_id ORDER BY position DESC) AS rn
  FROM change_log WHERE position % 5 <> 0) WHERE rn = 1 AND op <> 'd'""", "change_log")
block("exact_log", """
SELECT op, order_id, account_id, status, position,
  CASE WHEN position % 11 = 0 THEN 999999999999999999::HUGEINT
    ELSE round(amount * 100)::HUGEINT * CASE WHEN position % 2 = 0 THEN 1 ELSE -1 END END AS cents
FROM change_log WHERE position % 7 <> 0""", "change_log")
_EXACT = """
SELECT order_id, account_id, status, make_timestamp((position * 1000000)::BIGINT) AS changed_at,
  CASE WHEN cents < 0 THEN '-' ELSE '' END || (abs(cents) // 100)::VARCHAR || '.'
    || lpad((abs(cents) % 100)::VARCHAR, 2, '0') AS amount
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY position DESC) AS rn FROM exact_log)
WHERE rn = 1 AND op <> 'd'"""
oracle("cdc_typed", _EXACT, "exact_log")
oracle("cdc_live", _EXACT, "exact_log")
oracle("cdc_unreadable", "SELECT position FROM change_log WHERE position % 7 = 0", "change_log")
oracle("upsert_null_key", """
SELECT nullif(channel, 'UNKNOWN') AS channel, ingested_at, 'reversed' AS status, amount, transaction_id
FROM silver_transactions QUALIFY row_number() OVER (
  PARTITION BY channel ORDER BY ingested_at DESC, transaction_id DESC) = 1""", "silver_transactions")
oracle("upsert_partial", """
SELECT transaction_id, ingested_at, CASE status WHEN 'failed' THEN 'reversed' ELSE status END AS status,
  amount FROM silver_transactions""", "silver_transactions")
oracle("upsert_null_partition", """
SELECT transaction_id, ingested_at, nullif(channel, 'UNKNOWN') AS channel,
  CASE WHEN transaction_id LIKE '%1' AND channel IN ('UNKNOWN', 'app') THEN 1.0 ELSE amount END AS amount
FROM silver_transactions""", "silver_transactions")
_VERSIONED = """
WITH f AS (SELECT o_custkey % 20 AS k, date_trunc('month', l_shipdate)::TIMESTAMP AS at,
    l_extendedprice AS price, row_number() OVER (PARTITION BY o_custkey % 20, date_trunc('month', l_shipdate)
      ORDER BY nullif(l_linenumber % 4, 0) DESC NULLS LAST, l_extendedprice DESC) AS rn
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
l AS (SELECT o_orderkey, nullif(o_custkey % 20, 0) AS k, o_orderdate::TIMESTAMP AS label_time FROM orders)
SELECT l.*, f.at AS feature_time, f.price
FROM l ASOF LEFT JOIN (SELECT * FROM f WHERE rn = 1) f ON f.k = l.k AND l.label_time >= f.at"""
oracle("point_in_time_versions", _VERSIONED)
oracle("point_in_time_dealt", _VERSIONED)

_FAULTY = """
WITH r AS (SELECT nullif(o_custkey % 37, 0)::VARCHAR AS key, nullif(o_orderkey % 11, 0)::VARCHAR AS owner,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS made, strftime(o_orderdate, '%Y-%m-%d') AS day,
    o_orderpriority AS label FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY label DESC, made DESC) AS by_label,
    row_number() OVER (PARTITION BY key ORDER BY owner DESC NULLS LAST, made DESC) AS by_owner,
    row_number() OVER (PARTITION BY key ORDER BY owner DESC NULLS LAST, label DESC, made DESC) AS by_all
  FROM r WHERE key IS NOT NULL)
"""
oracle("clean_faulty", _FAULTY + """
SELECT 'users' AS table_name, key || '|' || label || '|' || made AS row FROM n WHERE by_label = 1
UNION ALL SELECT 'accounts', key || '|' || owner || '|' || made FROM n WHERE by_owner = 1 AND owner IS NOT NULL
UNION ALL SELECT 'merchants', key || '|' || label FROM n WHERE by_label = 1
UNION ALL SELECT 'devices', key || '|' || owner || '|' || made FROM n WHERE by_owner = 1 AND owner IS NOT NULL
UNION ALL SELECT 'login_events', key || '|' || owner || '|' || label || '|' || made || '|' || day FROM n
  WHERE by_all = 1 AND owner IS NOT NULL""")
oracle("missing_columns", "SELECT count(*) AS row_count, 'channel,type' AS missing FROM transactions",
       "transactions")
oracle("account_owners", """
SELECT a.user_id AS owner_id, count(*) AS transaction_count
FROM transactions t LEFT JOIN accounts a USING (account_id) GROUP BY 1""", "transactions", "accounts")
oracle("repeatable_sample", """
SELECT transaction_id, type, old_balance, amount, new_balance FROM transactions
ORDER BY md5(transaction_id || '|42'), transaction_id LIMIT 20""", "transactions")
