"""Data-quality rules, reports and gates.

All rules of a table come out of one scan: rows are grouped by the table's key with one counter
per rule, and the groups are summed up. The grouping gives uniqueness, the sums give the rest, and
a hot key is folded on the map side. Reports are DataFrames with one row per rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import config
from ledgerlake.functions.columns import any_of, missing_any, negative_any
from ledgerlake.operators.joins import orphan_keys

REPORT_COLUMNS = ("rule_name", "passed", "actual_value", "expected")

# The texts a report shows for what each rule expects.
EXPECT_ROWS = "row_count > 0"
EXPECT_NO_NULL_KEY = "0 null-key rows"
EXPECT_NO_NULL = "0 NULL required rows"
EXPECT_UNIQUE = "0 duplicate key groups"
EXPECT_NOT_NEGATIVE = "0 negative metric rows"
EXPECT_EQUAL = "row counts must be equal"
EXPECT_NO_ORPHANS = "0 orphan keys"
EXPECT_CHANNEL = "0 NULL channel rows"
EXPECT_AMOUNT = "0 rows with amount <= 0"
EXPECT_BALANCE = "0 negative balance rows"
EXPECT_TYPE = "0 invalid transaction types"
EXPECT_STATUS = "0 invalid transaction status rows"
EXPECT_CLOSING = "0 negative closing_balance rows"
EXPECT_RATE = "0 invalid rate rows"


class DataQualityError(RuntimeError):
    """At least one rule failed; the message lists them."""


@dataclass(frozen=True)
class RowRule:
    """A rule broken by single rows: `broken` is true for an offending row, NULL passes."""

    name: str
    broken: Column
    expected: str


@dataclass(frozen=True)
class RuleSet:
    table: str
    key: tuple[str, ...]
    required: tuple[str, ...]
    row_rules: tuple[RowRule, ...] = field(default=())
    gold: bool = False

    @property
    def null_rule(self) -> RowRule:
        if self.gold:
            return RowRule(f"{self.table}.required_columns_not_null",
                           missing_any(*self.required), EXPECT_NO_NULL)
        return RowRule(f"{self.table}.null_key", missing_any(*self.required), EXPECT_NO_NULL_KEY)

    @property
    def unique_name(self) -> str:
        return (f"{self.table}.unique_key({','.join(self.key)})" if self.gold
                else f"{self.table}.duplicate_key")


def outside(column: str, allowed: Sequence[str]) -> Column:
    return ~F.col(column).isin(*allowed)


def non_negative(table: str, *columns: str) -> RowRule:
    return RowRule(f"{table}.non_negative_metrics", negative_any(*columns), EXPECT_NOT_NEGATIVE)


def valid_rate(table: str, column: str, label: str) -> RowRule:
    broken = any_of([F.col(column).isNull(), F.col(column) < 0, F.col(column) > 1])
    return RowRule(f"{table}.{label}_between_0_and_1", broken, EXPECT_RATE)


def silver_rules() -> dict[str, RuleSet]:
    tx = "transactions"
    return {r.table: r for r in (
        RuleSet("users", ("user_id",), ("user_id",)),
        RuleSet("accounts", ("account_id",), ("account_id", "user_id")),
        RuleSet("merchants", ("merchant_id",), ("merchant_id",)),
        RuleSet("devices", ("device_id",), ("device_id", "user_id")),
        RuleSet(tx, ("transaction_id",), ("transaction_id", "account_id", "user_id"), (
            RowRule(f"{tx}.channel_not_null", F.col("channel").isNull(), EXPECT_CHANNEL),
            RowRule(f"{tx}.valid_amount", F.col("amount") <= 0, EXPECT_AMOUNT),
            RowRule(f"{tx}.valid_balance", negative_any("old_balance", "new_balance"),
                    EXPECT_BALANCE),
            RowRule(f"{tx}.valid_type", outside("type", config.TRANSACTION_TYPES), EXPECT_TYPE),
            RowRule(f"{tx}.valid_status", outside("status", config.TRANSACTION_STATUSES),
                    EXPECT_STATUS),
        )),
        RuleSet("balance_snapshots", ("account_id", "snapshot_date"),
                ("account_id", "snapshot_date"), (
            RowRule("balance_snapshots.valid_balance", negative_any("closing_balance"),
                    EXPECT_CLOSING),)),
        RuleSet("login_events", ("login_id",), ("login_id", "user_id", "device_id")),
    )}


def gold_rules() -> dict[str, RuleSet]:
    def rules(table, key, required, *row_rules):
        return RuleSet(table, key, required, row_rules, gold=True)

    money = ("amount", "old_balance", "new_balance")
    return {r.table: r for r in (
        rules("dim_user", ("user_id",), ("user_id",)),
        rules("dim_account", ("account_id",), ("account_id",)),
        rules("dim_merchant", ("merchant_id",), ("merchant_id",)),
        rules("dim_device", ("device_id",), ("device_id",)),
        rules("dim_date", ("date_key",), ("date_key",)),
        rules("fact_transactions", ("transaction_id",),
              ("transaction_id", "user_id", "account_id", "date_key", "event_date", "timestamp"),
              non_negative("fact_transactions", *money)),
        rules("fact_login_events", ("login_id",),
              ("login_id", "user_id", "device_id", "date_key", "login_ts", "event_date")),
        rules("fact_balance_snapshot", ("account_id", "snapshot_date"),
              ("account_id", "date_key", "snapshot_date", "closing_balance"),
              non_negative("fact_balance_snapshot", "closing_balance")),
        rules("obt_transaction_enriched", ("transaction_id",),
              ("transaction_id", "user_id", "account_id", "date_key", "timestamp", "event_date"),
              non_negative("obt_transaction_enriched", *money)),
        rules("feat_user_90d", ("user_id",),
              ("user_id", "event_timestamp", "created_timestamp"),
              non_negative("feat_user_90d", "f_user_total_transactions_90d",
                           "f_user_avg_transaction_amount_90d", "f_user_distinct_merchants_90d"),
              valid_rate("feat_user_90d", "f_user_failed_transaction_rate_90d",
                         "failed_transaction_rate")),
        rules("opt_merchant_performance", ("merchant_id",), ("merchant_id",),
              non_negative("opt_merchant_performance", "transaction_count", "total_amount",
                           "avg_amount", "success_count", "failed_count", "distinct_users")),
    )}


# The row-count contracts (left table, right table) between and inside the layers.
SILVER_TO_GOLD = (
    ("users", "dim_user"), ("accounts", "dim_account"), ("merchants", "dim_merchant"),
    ("devices", "dim_device"), ("transactions", "fact_transactions"),
    ("login_events", "fact_login_events"), ("balance_snapshots", "fact_balance_snapshot"),
)
GOLD_TO_GOLD = (
    ("fact_transactions", "obt_transaction_enriched"), ("dim_user", "feat_user_90d"),
    ("dim_merchant", "opt_merchant_performance"),
)
DATED_FACTS = ("fact_transactions", "fact_login_events", "fact_balance_snapshot")


def _row(name: str, passed: Column, actual: Column, expected: str) -> Column:
    return F.struct(F.lit(name).alias("rule_name"), passed.alias("passed"),
                    actual.cast("string").alias("actual_value"), F.lit(expected).alias("expected"))


def _zero_row(name: str, count: str, expected: str) -> Column:
    return _row(name, F.col(count) == 0, F.col(count), expected)


def _stack(df: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*rows)))


def table_report(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Every rule of one table, from one scan and one shuffle on its key."""
    checks = [rules.null_rule, *rules.row_rules]
    counters = [f"_broken{i}" for i in range(len(checks))]
    per_key = df.groupBy(*rules.key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(check.broken).alias(c) for check, c in zip(checks, counters, strict=True)])
    totals = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"),
        F.count_if(F.col("_rows") > 1).alias("_groups"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters])
    null_row, *others = (_zero_row(check.name, c, check.expected)
                         for check, c in zip(checks, counters, strict=True))
    return _stack(totals, [
        _row(f"{rules.table}.non_empty", F.col("_rows") > 0, F.col("_rows"), EXPECT_ROWS),
        null_row,
        _zero_row(rules.unique_name, "_groups", EXPECT_UNIQUE),
        *others,
    ])


def contract_name(left: str, right: str, across: bool) -> str:
    return f"{'silver.' if across else ''}{left}_count_equals_{right}_count"


def row_count_report(
    tables: Mapping[str, DataFrame], contracts: Sequence[tuple[str, str]], across: bool,
) -> DataFrame:
    """Equal-row-count contracts between named tables; each table is counted once."""
    sides: dict[str, list[tuple[str, str]]] = {}
    for left, right in contracts:
        name = contract_name(left, right, across)
        sides.setdefault(left, []).append((name, "l"))
        sides.setdefault(right, []).append((name, "r"))
    counts = []
    for table, uses in sides.items():
        n = tables[table].agg(F.count(F.lit(1)).alias("n"))
        rows = [F.struct(F.lit(name).alias("rule_name"),
                         (F.col("n") if side == "l" else F.lit(None).cast("long")).alias("l"),
                         (F.col("n") if side == "r" else F.lit(None).cast("long")).alias("r"))
                for name, side in uses]
        counts.append(_stack(n, rows))
    both = reduce(DataFrame.unionByName, counts).groupBy("rule_name").agg(
        F.max("l").alias("l"), F.max("r").alias("r"))
    return both.select(
        "rule_name", (F.col("l") == F.col("r")).alias("passed"),
        F.concat_ws(" vs ", F.col("l").cast("string"), F.col("r").cast("string"))
        .alias("actual_value"),
        F.lit(EXPECT_EQUAL).alias("expected"))


def foreign_key_report(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, name: str,
) -> DataFrame:
    orphans = orphan_keys(child, parent, child_key, parent_key).agg(
        F.count(F.lit(1)).alias("_orphans"))
    return _stack(orphans, [_zero_row(name, "_orphans", EXPECT_NO_ORPHANS)])


def silver_report(silver: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName,
                  (table_report(silver[t], rules) for t, rules in silver_rules().items()))


def gold_report(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> DataFrame:
    """Rules of all Gold tables, the row-count contracts and the date foreign keys."""
    parts = [table_report(gold[t], rules) for t, rules in gold_rules().items()]
    parts.append(row_count_report({**silver, **gold}, SILVER_TO_GOLD, across=True))
    parts.append(row_count_report(gold, GOLD_TO_GOLD, across=False))
    parts += [
        foreign_key_report(gold[f], gold["dim_date"], "date_key", "date_key",
                           f"{f}.date_key_exists_in_dim_date")
        for f in DATED_FACTS]
    return reduce(DataFrame.unionByName, parts)


def gate(report: DataFrame) -> list:
    """Run a report (a few rows per table) and raise when any rule failed."""
    rows = report.collect()
    failed = [f"{r.rule_name}: actual={r.actual_value}, expected {r.expected}"
              for r in rows if not r.passed]
    if failed:
        raise DataQualityError("; ".join(failed))
    return rows


def transaction_gate(silver: DataFrame) -> list:
    """The check before Silver transactions are written: unique, channel set, not empty."""
    return gate(table_report(silver, RuleSet(
        "transactions", ("transaction_id",), ("transaction_id",), (
            RowRule("transactions.channel_not_null", F.col("channel").isNull(), EXPECT_CHANNEL),))))


def table_quality(
    bronze: Mapping[str, DataFrame], silver: Mapping[str, DataFrame],
) -> DataFrame:
    """Bronze, Silver and removed rows per table."""
    def counted(df: DataFrame, table: str, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(table).alias("table_name"), name)

    both = [
        counted(bronze[t], t, "bronze_rows")
        .unionByName(counted(silver[t], t, "silver_rows"), allowMissingColumns=True)
        for t in silver]
    return reduce(DataFrame.unionByName, both).groupBy("table_name").agg(
        F.max("bronze_rows").alias("bronze_rows"), F.max("silver_rows").alias("silver_rows"),
    ).withColumn("removed_rows", F.col("bronze_rows") - F.col("silver_rows"))
