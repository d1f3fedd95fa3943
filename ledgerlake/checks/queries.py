"""Every operator as a query over the supplied tables: name -> function(spark, sf_dir)."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake import config
from ledgerlake.functions import columns as X
from ledgerlake.operators import change, clean, dedup, features, incremental, joins, merchants, model, profile
from ledgerlake.operators import quality as dq
from ledgerlake.operators.enrich import enrich_transactions
from ledgerlake.plans import gold as gold_plan
from ledgerlake.sources import catalog, layout, tables
from ledgerlake.sources.compaction import compact_small, file_name, manifest, read_live
from ledgerlake.sources.supplied import raw, wallet
from ledgerlake.sources.workspace import fresh_path, written
from ledgerlake.streaming import events as stream_in
from ledgerlake.streaming import jobs, replay, watermarks
from ledgerlake.streaming.changes import LiveTable
from ledgerlake.streaming.topics import export_topic, topic_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The supplied stream never has 100 arrivals in ten seconds; two is its busy level.
BUSY = 2
#: Lines of a large file of `compaction_selective`.
LINES_A_FILE = 1_000_000
#: Lines of a file of `cdc_live`'s stream: compressed text is read by one task a file.
LINES_SENT = 100_000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def shown(df: DataFrame) -> DataFrame:
    """Clock columns without a zone and dates as ISO text, so every SQL engine prints them alike."""
    casts = {"timestamp": "timestamp_ntz", "date": "string"}
    changed = {c: F.col(c).cast(casts[kind]) for c, kind in df.dtypes if kind in casts}
    return df.withColumns(changed) if changed else df


def cents(total: Column) -> Column:
    """A money sum without the last bits that depend on summation order."""
    return F.round(total, 2)


def mean_cents(mean: Column, n: Column) -> Column:
    """A money average rebuilt from its cent-exact total, again free of summation order."""
    return F.when(n == 0, F.lit(0.0)).otherwise(F.round(mean * n, 2) / n)


def silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return clean.CLEANERS[table](wallet(spark, sf_dir, table))


def silver_zone(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: silver(spark, sf_dir, t) for t in config.TABLES}


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.fact_transactions(silver(spark, sf_dir, "transactions"))


@cache
def _prepared(application: str, sf_dir: str) -> tuple[config.Lakehouse, DataFrame]:
    spark = SparkSession.active()
    lake = config.Lakehouse(fresh_path(spark, "prepared"))
    tables.write_table(silver(spark, sf_dir, "login_events"), lake.path("silver", "login_events"),
                       partition_by=config.TABLES["login_events"].partition_by)
    json_lines(spark, sf_dir).write.text(lake.path("bronze", "event_lines"))
    return lake, tables.read_table(spark, lake, "silver", "login_events")


def prepared(spark: SparkSession, sf_dir: str) -> config.Lakehouse:
    """Inputs that several queries read back from disk; written once per session."""
    return _prepared(spark.sparkContext.applicationId, sf_dir)[0]


def stored_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver logins as stored, one folder per date."""
    return _prepared(spark.sparkContext.applicationId, sf_dir)[1]


def live_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_in.file_lines(spark, prepared(spark, sf_dir).path("bronze", "event_lines"))


# --- Scans and sinks --------------------------------------------------------------------------


@query
def scan_zone(spark, sf_dir):
    return shown(stored_logins(spark, sf_dir))


@query
def scan_pruned(spark, sf_dir):
    return tables.read_present(stored_logins(spark, sf_dir), "login_id")


@query
def bronze_normalize(spark, sf_dir):
    return shown(tables.normalize_bronze(wallet(spark, sf_dir, "transactions"), "transactions"))


@query
def write_verify(spark, sf_dir):
    done = [
        tables.write_verified(
            tables.normalize_bronze(wallet(spark, sf_dir, t), t), t,
            fresh_path(spark, f"bronze-{t}"))
        for t in config.TABLES]
    return spark.createDataFrame(
        [(d.table, d.source_rows, d.target_rows) for d in done],
        "table_name string, source_rows long, target_rows long")


@query
def ingest_summary(spark, sf_dir):
    out = tables.ingest(
        spark, config.Lakehouse(fresh_path(spark, "ingest")), lambda t: wallet(spark, sf_dir, t),
        ["merchants", "users", "merchants", "login_events"], continue_on_error=True)
    return out.select("table_name", "source_rows", "target_rows", "error")


@query
def partitioned_write(spark, sf_dir):
    return shown(stored_logins(spark, sf_dir).groupBy("login_date").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("is_success").alias("success_count")))


@query
def partition_prune(spark, sf_dir):
    recent = stored_logins(spark, sf_dir).filter(
        F.col("login_date").between("2024-01-10", "2024-01-16"))
    return recent.groupBy("is_success").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("user_id").alias("user_count"))


@query
def schema_merge(spark, sf_dir):
    """Files from before and after a schema change read as one table; old rows lack the column."""
    path = fresh_path(spark, "evolved")
    tx = wallet(spark, sf_dir, "transactions")
    old = tx.filter("channel IS NULL").drop("channel")
    tables.write_table(old, f"{path}/bronze/transactions/era=old")
    tables.write_table(tx.filter("channel IS NOT NULL"), f"{path}/bronze/transactions/era=new")
    merged = tables.read_table(
        spark, config.Lakehouse(path), "bronze", "transactions", merge_schema=True)
    return merged.groupBy("era", "channel").agg(F.count(F.lit(1)).alias("row_count"))


@query
def catalog_register(spark, sf_dir):
    path = prepared(spark, sf_dir).path("silver", "login_events")
    table = "login_events_" + path.split("/")[-3].rsplit("-", 1)[1]
    entry = catalog.register_verified(spark, "ledgerlake_check", table, path,
                                      database_location=fresh_path(spark, "database"))
    return spark.table(entry.name).agg(F.count(F.lit(1)).alias("catalog_rows"))


@query
def layout_report(spark, sf_dir):
    return layout.layout_report(stored_logins(spark, sf_dir), "silver.login_events",
                                config.TABLES["login_events"].partition_by)


@query
def layout_rows(spark, sf_dir):
    return layout_report(spark, sf_dir).select("table_name", "row_count")


@query
def compaction(spark, sf_dir):
    before = prepared(spark, sf_dir).path("silver", "login_events")
    after = fresh_path(spark, "compacted")
    layout.compact(spark, before, after)
    return layout.layout_report(spark.read.parquet(before), "before").unionByName(
        layout.layout_report(spark.read.parquet(after), "after"))


@query
def compaction_keeps_rows(spark, sf_dir):
    after = fresh_path(spark, "compacted")
    layout.compact(spark, prepared(spark, sf_dir).path("silver", "login_events"), after)
    return shown(spark.read.parquet(after))


@query
def compaction_selective(spark, sf_dir):
    """Half of the order lines in large files, half in small files, of which only those are rewritten.

    There is a large file per flag for every `LINES_A_FILE` lines, so that no task writes more than that.
    `selected`: rows of one quarter and price range, from fewer files than are live.
    """
    root = fresh_path(spark, "selective")
    rows = raw(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        F.col("l_extendedprice").cast("double").alias("l_extendedprice"))
    even = F.col("l_orderkey") % 2 == 0
    large = 1 + rows.filter(even).count() // LINES_A_FILE
    for part, n in ((rows.filter(even), large), (rows.filter(~even), 40 * large)):
        part.repartition(n).write.mode("append").partitionBy("l_returnflag").parquet(f"{root}/data")
    per_file = spark.read.parquet(f"{root}/data").select(file_name().alias("file"),
                                                         F.col("_metadata.file_size").alias("size")).distinct()
    before = {r.file: r.size for r in per_file.collect()}  # at most 41 files a flag and LINES_A_FILE lines
    small = max(before.values()) // 4
    compact_small(spark, root, ("l_shipdate", "l_extendedprice"), ("l_returnflag",), small, small)
    live = {r.file for r in manifest(spark, root).select("file").collect()}
    within = {"l_shipdate": (datetime.date(1995, 1, 1), datetime.date(1995, 3, 31)), "l_extendedprice": (0.0, 20000.0)}
    few = read_live(spark, root, within)
    selected = few.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("selected"))
    return (read_live(spark, root).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), cents(F.sum("l_extendedprice")).alias("total"))
        .join(selected, "l_returnflag", "left").select(
            "l_returnflag", "n", "total", F.coalesce("selected", F.lit(0)).alias("selected"),
            F.lit(live & before.keys() == {f for f, size in before.items() if size >= small}).alias("large_kept"),
            F.lit(len(live) < len(before)).alias("fewer_files"),
            F.lit(len(few.inputFiles()) < len(live)).alias("pruned")))


# --- Cleaning and columns ---------------------------------------------------------------------


@query
def clean_transactions(spark, sf_dir):
    return shown(silver(spark, sf_dir, "transactions"))


@query
def clean_users(spark, sf_dir):
    return shown(silver(spark, sf_dir, "users"))


@query
def clean_accounts(spark, sf_dir):
    return shown(silver(spark, sf_dir, "accounts"))


@query
def clean_merchants(spark, sf_dir):
    return silver(spark, sf_dir, "merchants")


@query
def clean_devices(spark, sf_dir):
    return shown(silver(spark, sf_dir, "devices"))


@query
def clean_snapshots(spark, sf_dir):
    return shown(silver(spark, sf_dir, "balance_snapshots"))


@query
def clean_logins(spark, sf_dir):
    return shown(silver(spark, sf_dir, "login_events"))


def faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of small tables: keys that repeat often, and some that are missing."""
    key = F.nullif(F.col("o_custkey") % 37, F.lit(0))
    owner = F.nullif(F.col("o_orderkey") % 11, F.lit(0))
    return raw(spark, sf_dir, "orders").select(
        key.cast("string").alias("key"), owner.cast("string").alias("owner"),
        F.col("o_orderdate").cast("timestamp").alias("at"), F.col("o_orderpriority").alias("label"))


@query
def clean_faulty(spark, sf_dir):
    """The cleaners of the small tables on rows that they must drop or merge."""
    rows = faulty(spark, sf_dir)
    named = {
        "users": clean.clean_users(rows.select(F.col("key").alias("user_id"), "label", F.col("at").alias("created_at"))),
        "accounts": clean.clean_accounts(rows.select(
            F.col("key").alias("account_id"), F.col("owner").alias("user_id"), F.col("at").alias("created_at"))),
        "merchants": clean.clean_merchants(rows.select(F.col("key").alias("merchant_id"), "label")),
        "devices": clean.clean_devices(rows.select(
            F.col("key").alias("device_id"), F.col("owner").alias("user_id"), F.col("at").alias("first_seen_at"))),
        "login_events": clean.clean_login_events(rows.select(
            F.col("key").alias("login_id"), F.col("owner").alias("user_id"), F.col("label").alias("device_id"),
            F.col("at").alias("login_ts")))}
    out = None
    for name, df in named.items():
        row = df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *[
            F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns]).alias("row"))
        out = row if out is None else out.unionByName(row)
    return out


@query
def missing_columns(spark, sf_dir):
    """What the column contract says of a table that lacks declared columns."""
    short = wallet(spark, sf_dir, "transactions").drop("channel", "type")
    try:
        tables.normalize_bronze(short, "transactions")
        said = ""
    except tables.IngestError as error:
        said = str(error)
    found = [c for c in ("channel", "type") if c in said]
    return short.agg(F.count(F.lit(1)).alias("row_count")).withColumn("missing", F.lit(",".join(found)))


@query
def account_owners(spark, sf_dir):
    """Key lookup: transactions by the owner of their account."""
    owners = wallet(spark, sf_dir, "accounts").select("account_id", F.col("user_id").alias("owner_id"))
    tx = wallet(spark, sf_dir, "transactions").select("account_id")
    return joins.left_lookup(tx, owners, "account_id").groupBy("owner_id").agg(
        F.count(F.lit(1)).alias("transaction_count"))


@query
def ensure_column(spark, sf_dir):
    old = wallet(spark, sf_dir, "transactions").drop("channel")
    new = clean.typed_transactions(old)
    return new.groupBy("channel").agg(F.count(F.lit(1)).alias("row_count"))


@query
def normalize_channel(spark, sf_dir):
    tx = clean.typed_transactions(wallet(spark, sf_dir, "transactions"))
    return tx.groupBy("channel").agg(F.count(F.lit(1)).alias("row_count"))


@query
def domain_filter(spark, sf_dir):
    tx = clean.typed_transactions(wallet(spark, sf_dir, "transactions")).filter(X.in_domain())
    return tx.groupBy("type", "status", "channel", "currency").agg(
        F.count(F.lit(1)).alias("row_count"))


@query
def balance_rule(spark, sf_dir):
    return profile.balance_rule_by_status(wallet(spark, sf_dir, "transactions"))


@query
def dedup_latest(spark, sf_dir):
    return shown(dedup.keep_latest(
        wallet(spark, sf_dir, "transactions"), ["transaction_id"], ["ingested_at"]))


@query
def dedup_any(spark, sf_dir):
    return shown(dedup.keep_any(
        wallet(spark, sf_dir, "balance_snapshots"), ["account_id", "snapshot_date"]))


@query
def dedup_any_keys(spark, sf_dir):
    kept = dedup.keep_any(wallet(spark, sf_dir, "balance_snapshots"),
                          ["account_id", "snapshot_date"], repeatable=False)
    return shown(kept.select("account_id", "snapshot_date"))


@query
def dup_stats(spark, sf_dir):
    return dedup.repeat_stats(wallet(spark, sf_dir, "transactions"), "transaction_id")


@query
def unique_key_violations(spark, sf_dir):
    return dedup.repeated_keys(wallet(spark, sf_dir, "transactions"), ["transaction_id"])


# --- Gold model -------------------------------------------------------------------------------


@query
def dim_user(spark, sf_dir):
    return shown(model.dim_user(silver(spark, sf_dir, "users")))


@query
def dim_account(spark, sf_dir):
    return shown(model.dim_account(silver(spark, sf_dir, "accounts")))


@query
def dim_merchant(spark, sf_dir):
    return model.dim_merchant(silver(spark, sf_dir, "merchants"))


@query
def dim_device(spark, sf_dir):
    return shown(model.dim_device(silver(spark, sf_dir, "devices")))


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.dim_date(*(silver(spark, sf_dir, t)
                            for t in ("transactions", "login_events", "balance_snapshots")))


@query
def dim_date(spark, sf_dir):
    return shown(dates(spark, sf_dir))


@query
def fact_transactions(spark, sf_dir):
    return shown(fact(spark, sf_dir))


@query
def fact_logins(spark, sf_dir):
    return shown(model.fact_login_events(silver(spark, sf_dir, "login_events")))


@query
def fact_snapshots(spark, sf_dir):
    return shown(model.fact_balance_snapshot(silver(spark, sf_dir, "balance_snapshots")))


@query
def obt(spark, sf_dir):
    rows = written(fact(spark, sf_dir), "fact")  # read for its keys, its days and its rows
    return shown(enrich_transactions(
        rows,
        model.dim_user(silver(spark, sf_dir, "users")),
        model.dim_account(silver(spark, sf_dir, "accounts")),
        model.dim_device(silver(spark, sf_dir, "devices")),
        model.dim_merchant(silver(spark, sf_dir, "merchants")),
        model.dim_date(rows, silver(spark, sf_dir, "login_events"), silver(spark, sf_dir, "balance_snapshots"))))


# --- Features and merchant analytics ----------------------------------------------------------


def rounded_features(df: DataFrame) -> DataFrame:
    return shown(df.withColumn(
        features.AVERAGE, mean_cents(F.col(features.AVERAGE), F.col(features.TOTAL)),
    ).drop("created_timestamp"))


@query
def feat_user_90d(spark, sf_dir):
    return rounded_features(features.user_features_90d(
        fact(spark, sf_dir), model.dim_user(silver(spark, sf_dir, "users"))))


@query
def feat_user_90d_incremental(spark, sf_dir):
    """The same from stored daily partials, after all days but two, the day before the last twice, and the last."""
    rows = written(fact(spark, sf_dir), "fact")
    users = written(model.dim_user(silver(spark, sf_dir, "users")), "users")
    path, out = fresh_path(spark, "partials"), None
    ago = F.datediff(rows.agg(F.max(F.to_date("timestamp"))).scalar(), F.to_date("timestamp"))
    for days in (ago >= 2, ago == 1, ago == 1, ago == 0):
        so_far = rows if out is not None else rows.filter(days)
        out = written(incremental.refresh_user_features(path, rows.filter(days), so_far, users, out), "features")
    return rounded_features(out)


def rounded_merchants(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "avg_amount": mean_cents(F.col("avg_amount"), F.col("transaction_count")),
        "total_amount": cents(F.col("total_amount"))})


@query
def merchant_performance(spark, sf_dir):
    return rounded_merchants(merchants.merchant_performance(
        fact(spark, sf_dir), silver(spark, sf_dir, "merchants")))


@query
def merchant_workload(spark, sf_dir):
    return rounded_merchants(merchants.merchant_workload(
        wallet(spark, sf_dir, "transactions"), wallet(spark, sf_dir, "merchants")))


@query
def merchant_workload_salted(spark, sf_dir):
    return rounded_merchants(merchants.merchant_workload(
        wallet(spark, sf_dir, "transactions"), wallet(spark, sf_dir, "merchants"), salts=16))


@query
def merchant_workload_join_first(spark, sf_dir):
    return rounded_merchants(merchants.merchant_workload_join_first(
        wallet(spark, sf_dir, "transactions"), wallet(spark, sf_dir, "merchants")))


@query
def control_totals(spark, sf_dir):
    totals = merchants.control_totals(merchants.merchant_workload(
        wallet(spark, sf_dir, "transactions"), wallet(spark, sf_dir, "merchants")))
    return totals.withColumn("total_amount", cents(F.col("total_amount")))


@query
def conditional_counts(spark, sf_dir):
    return wallet(spark, sf_dir, "transactions").groupBy("type").agg(
        *[F.count_if(F.col("status") == s).alias(f"{s}_count")
          for s in config.TRANSACTION_STATUSES])


@query
def merchant_skew_profile(spark, sf_dir):
    return profile.skew_profile(wallet(spark, sf_dir, "transactions"), "merchant_id")


@query
def top_merchants(spark, sf_dir):
    return profile.top_keys(wallet(spark, sf_dir, "transactions"), "merchant_id")


@query
def top_share(spark, sf_dir):
    payments = wallet(spark, sf_dir, "transactions").filter("type = 'payment'")
    return profile.member_rate(payments, "merchant_id", profile.top_members(payments, "merchant_id"))


@query
def top_share_members(spark, sf_dir):
    """The keys themselves, among very many that have equally many rows."""
    return profile.top_members(raw(spark, sf_dir, "lineitem"), "l_orderkey")


# --- Profiles ---------------------------------------------------------------------------------


@query
def distinct_exact(spark, sf_dir):
    return profile.distinct_exact(wallet(spark, sf_dir, "transactions"), "transaction_id")


@query
def distinct_approx(spark, sf_dir):
    return profile.distinct_approx(wallet(spark, sf_dir, "transactions"), "transaction_id")


@query
def distinct_compare(spark, sf_dir):
    return profile.distinct_compare(wallet(spark, sf_dir, "transactions"), "transaction_id")


@query
def distinct_error_bound(spark, sf_dir):
    """The exact count, and whether the sketch stays within three standard errors of it."""
    both = distinct_compare(spark, sf_dir)
    bound = 3 * 100 * config.DEFAULT_RSD
    return both.select("exact_count", (F.col("relative_error_pct") <= bound).alias("within_bound"))


CARDINALITY_COLUMNS = ("transaction_id", "account_id", "merchant_id", "type")


@query
def cardinality_report(spark, sf_dir):
    return profile.cardinality_report(wallet(spark, sf_dir, "transactions"), CARDINALITY_COLUMNS)


@query
def cardinality_within_bound(spark, sf_dir):
    """Per column: does the sketch stay within three standard errors of the exact count?"""
    tx = wallet(spark, sf_dir, "transactions")
    exact = tx.agg(*[F.count_distinct(c).alias(c) for c in CARDINALITY_COLUMNS]).unpivot(
        [], list(CARDINALITY_COLUMNS), "column_name", "exact_distinct")
    off = F.abs(F.col("approx_distinct") - F.col("exact_distinct"))
    return cardinality_report(spark, sf_dir).join(exact, "column_name").select(
        "column_name", "exact_distinct",
        (off <= 3 * config.DEFAULT_RSD * F.col("exact_distinct")).alias("within_bound"))


@query
def cardinality_incremental(spark, sf_dir):
    """Sketches stored by three loads, one of them repeated; reports over all time and over one year.

    The supplied rows span years, so a sketch is kept per month. No report reads the transactions
    again. `as_one_pass`: the same as merging a sketch over all rows at once.
    """
    tx = written(wallet(spark, sf_dir, "transactions").select(
        *CARDINALITY_COLUMNS, F.trunc("timestamp", "month").alias("day")), "counted")
    path = fresh_path(spark, "sketches")
    for low, high in (("1990-01-01", "1994-12-31"), ("1995-01-01", "1996-12-31"), ("1997-01-01", "2030-12-31"),
                      ("1995-01-01", "1996-12-31")):
        load = tx.filter(F.col("day").between(F.to_date(F.lit(low)), F.to_date(F.lit(high))))
        profile.add_sketches(profile.daily_sketches(load, CARDINALITY_COLUMNS, "day"), path)
    stored = spark.read.schema("column_name string, sketch binary, day date").parquet(path)
    at_once = profile.daily_sketches(tx.withColumn("day", F.to_date(F.lit("2000-01-01"))), CARDINALITY_COLUMNS, "day")

    def judged(name, rows, report):
        # column by column: counted at once, every row would be shuffled once for each column
        exact = reduce(DataFrame.unionByName, (rows.agg(F.count_distinct(c).alias("exact_distinct")).select(
            F.lit(c).alias("column_name"), "exact_distinct") for c in CARDINALITY_COLUMNS))
        off = F.abs(F.col("approx_distinct") - F.col("exact_distinct"))
        return report.join(exact, "column_name").select(
            F.lit(name).alias("days"), "column_name", "exact_distinct",
            (off <= 3 * config.DEFAULT_RSD * F.col("exact_distinct")).alias("within_bound"), "approx_distinct")
    whole = judged("all", tx, profile.distinct_between(stored)).join(
        profile.distinct_between(at_once.unionByName(at_once)).withColumnRenamed("approx_distinct", "_once"), "column_name").withColumn(
        "as_one_pass", F.col("_once") == F.col("approx_distinct")).drop("_once")
    year = judged("1995", tx.filter("year(day) = 1995"),
                  profile.distinct_between(stored, "1995-01-01", "1995-12-31")).withColumn("as_one_pass", F.lit(None).cast("boolean"))
    return whole.unionByName(year).drop("approx_distinct")


@query
def table_quality(spark, sf_dir):
    bronze = {t: wallet(spark, sf_dir, t) for t in config.TABLES}
    return dq.table_quality(bronze, silver_zone(spark, sf_dir))


@query
def hour_skew(spark, sf_dir):
    return profile.value_shares(
        wallet(spark, sf_dir, "transactions"), F.hour("timestamp"), "hour")


@query
def channel_skew(spark, sf_dir):
    return profile.value_shares(wallet(spark, sf_dir, "transactions"), F.col("channel"), "channel")


@query
def status_mix(spark, sf_dir):
    return profile.value_shares(wallet(spark, sf_dir, "transactions"), F.col("status"), "status")


@query
def null_rates(spark, sf_dir):
    return profile.null_rates(
        wallet(spark, sf_dir, "transactions"),
        ["merchant_id", "counterparty_account_id", "channel"])


@query
def failed_rule_rates(spark, sf_dir):
    return profile.failed_rule_rates(wallet(spark, sf_dir, "transactions"))


@query
def closing_balance(spark, sf_dir):
    return shown(profile.closing_balance(wallet(spark, sf_dir, "transactions")))


@query
def latest_balance(spark, sf_dir):
    return profile.latest_balance(
        wallet(spark, sf_dir, "accounts"), wallet(spark, sf_dir, "balance_snapshots"))


@query
def devices_by_user(spark, sf_dir):
    return profile.list_by_key(wallet(spark, sf_dir, "devices"), "user_id", "device_id",
                               "device_ids")


@query
def logins_by_user(spark, sf_dir):
    return profile.list_by_key(wallet(spark, sf_dir, "login_events"), "user_id", "login_id",
                               "login_ids")


@query
def events_per_minute(spark, sf_dir):
    return shown(profile.events_per_minute(wallet(spark, sf_dir, "stream_events")))


@query
def minutes_between(spark, sf_dir):
    per_minute = profile.events_per_minute(wallet(spark, sf_dir, "stream_events"))
    return shown(profile.minutes_between(per_minute, "2024-01-02", "17:15", "17:45"))


@query
def late_rate(spark, sf_dir):
    return profile.late_rate(wallet(spark, sf_dir, "stream_events"), event="event_time")


@query
def repeatable_sample(spark, sf_dir):
    return profile.repeatable_sample(
        wallet(spark, sf_dir, "transactions"), "transaction_id").select(
        "transaction_id", "type", "old_balance", "amount", "new_balance")


@query
def freshness(spark, sf_dir):
    tx, logins = (wallet(spark, sf_dir, t) for t in ("transactions", "login_events"))
    stream = wallet(spark, sf_dir, "stream_events")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    out = profile.freshness({"offline": (tx, "timestamp"), "unified": (logins, "login_ts"),
                             "streaming": (stream, "event_time")}, now)
    return shown(out.withColumn("lag_minutes", F.round("lag_minutes", 3)))


# --- Quality ----------------------------------------------------------------------------------


def report_of(spark: SparkSession, sf_dir: str, table: str, ending: str) -> DataFrame:
    """One rule of one raw (uncleaned) table, so that faults show up in the actual value."""
    report = dq.table_report(wallet(spark, sf_dir, table), dq.silver_rules()[table])
    return report.filter(F.col("rule_name") == f"{table}.{ending}")


@query
def dq_non_empty(spark, sf_dir):
    return report_of(spark, sf_dir, "login_events", "non_empty")


@query
def dq_null_keys(spark, sf_dir):
    rules = dq.RuleSet("transactions", ("transaction_id",), ("merchant_id", "channel"))
    report = dq.table_report(wallet(spark, sf_dir, "transactions"), rules)
    return report.filter("rule_name = 'transactions.null_key'")


@query
def dq_unique(spark, sf_dir):
    return report_of(spark, sf_dir, "balance_snapshots", "duplicate_key")


@query
def dq_non_negative(spark, sf_dir):
    rules = dq.RuleSet("fact_transactions", ("transaction_id",), ("transaction_id",), (
        dq.non_negative("fact_transactions", "amount", "old_balance", "new_balance"),), gold=True)
    report = dq.table_report(wallet(spark, sf_dir, "transactions"), rules)
    return report.filter("rule_name = 'fact_transactions.non_negative_metrics'")


@query
def dq_domain(spark, sf_dir):
    return dq.table_report(
        wallet(spark, sf_dir, "transactions"), dq.silver_rules()["transactions"])


@query
def dq_rate(spark, sf_dir):
    rates = features.user_features_90d(
        fact(spark, sf_dir), model.dim_user(silver(spark, sf_dir, "users")))
    report = dq.table_report(rates, dq.gold_rules()["feat_user_90d"])
    return report.filter(F.col("rule_name").endswith("between_0_and_1"))


@query
def dq_row_counts(spark, sf_dir):
    s = silver_zone(spark, sf_dir)
    gold = {
        "dim_user": model.dim_user(s["users"]), "dim_account": model.dim_account(s["accounts"]),
        "dim_merchant": model.dim_merchant(s["merchants"]),
        "dim_device": model.dim_device(s["devices"]),
        "fact_transactions": model.fact_transactions(s["transactions"]),
        "fact_login_events": model.fact_login_events(s["login_events"]),
        "fact_balance_snapshot": model.fact_balance_snapshot(s["balance_snapshots"])}
    return dq.row_count_report({**s, **gold}, dq.SILVER_TO_GOLD, across=True)


@query
def dq_row_counts_raw(spark, sf_dir):
    """The same contract between raw and cleaned tables, where it fails for the faulty ones."""
    raws = {t: wallet(spark, sf_dir, t) for t in config.TABLES}
    cleaned = {f"silver_{t}": silver(spark, sf_dir, t) for t in config.TABLES}
    return dq.row_count_report(
        {**raws, **cleaned}, [(t, f"silver_{t}") for t in config.TABLES], across=False)


@query
def fk_orphans(spark, sf_dir):
    return joins.orphan_keys(
        wallet(spark, sf_dir, "transactions"), wallet(spark, sf_dir, "merchants")
        .filter("category <> 'grocery'"), "merchant_id", "merchant_id")


@query
def dq_foreign_key(spark, sf_dir):
    return dq.foreign_key_report(
        wallet(spark, sf_dir, "transactions"), wallet(spark, sf_dir, "accounts"),
        "counterparty_account_id", "account_id",
        "transactions.counterparty_account_id_exists_in_accounts")


@query
def dq_silver(spark, sf_dir):
    return dq.silver_report(silver_zone(spark, sf_dir))


@query
def dq_gold(spark, sf_dir):
    s = {t: written(df, t) for t, df in silver_zone(spark, sf_dir).items()}  # built from, and then counted
    # The supplied rows spread over 2,400 days; a folder per day would hold a dozen rows each.
    gold = gold_plan.build_gold(
        spark, config.Lakehouse(fresh_path(spark, "gold")), s, partitions={})
    return dq.gold_report(s, gold)


@query
def dq_gate(spark, sf_dir):
    """The rows a passing gate returns for the cleaned transactions."""
    rows = dq.transaction_gate(silver(spark, sf_dir, "transactions"))
    return spark.createDataFrame(
        [tuple(r) for r in rows],
        "rule_name string, passed boolean, actual_value string, expected string")


# --- Streams ----------------------------------------------------------------------------------


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wallet(spark, sf_dir, "stream_events")


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplied stream as raw JSON messages."""
    line = stream_in.json_line(
        "transaction_id", "user_id", "amount", F.col("event_time").alias("timestamp"),
        "ingested_at", "seq")
    return stream(spark, sf_dir).select(line.alias("value"))


def as_sent(lines: DataFrame) -> DataFrame:
    """The supplied messages carry the broker's clock and position in their own fields."""
    return lines.withColumns({
        "arrived_at": F.get_json_object("value", "$.ingested_at").try_cast("timestamp"),
        "partition": F.lit("0"),
        "position": F.get_json_object("value", "$.seq").try_cast("long")})


def finish(query) -> None:
    query.awaitTermination()


@query
def stream_raw(spark, sf_dir):
    """Live: JSON messages pass through a bounded stream unchanged."""
    lines = live_lines(spark, sf_dir)
    out = fresh_path(spark, "raw")
    finish(jobs.run_raw(lines, f"{out}/data", f"{out}/checkpoint", bounded=True))
    return spark.read.parquet(f"{out}/data").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("value").alias("distinct_messages"))


@query
def stream_parse(spark, sf_dir):
    """Live: JSON messages parsed to typed events."""
    lines = live_lines(spark, sf_dir)
    out = fresh_path(spark, "parsed")
    finish(jobs.to_table(stream_in.valid_events(lines), f"{out}/data", f"{out}/checkpoint", True))
    return shown(spark.read.parquet(f"{out}/data").select(
        "transaction_id", "user_id", "amount", "event_time", "ingested_at", "seq"))


@query
def stream_quarantine(spark, sf_dir):
    """Messages cut off in transit (every text loses its last bracket) are all set aside."""
    broken = json_lines(spark, sf_dir).select(
        F.expr("substring(value, 1, length(value) - 1)").alias("value"))
    return stream_in.quarantined(broken).agg(F.count(F.lit(1)).alias("row_count"))


@query
def stream_dedup(spark, sf_dir):
    marked = replay.mark_repeats(stream(spark, sf_dir))
    return shown(marked.filter("NOT is_duplicate").drop("is_duplicate"))


@query
def stream_duplicates(spark, sf_dir):
    return shown(replay.mark_repeats(stream(spark, sf_dir)).filter("is_duplicate")
                 .drop("is_duplicate"))


@query
def stream_dedup_live(spark, sf_dir):
    """Live: keyed state flags the repeats in a bounded run over the JSON messages."""
    lines = live_lines(spark, sf_dir)
    out = fresh_path(spark, "marked")
    finish(jobs.run_marking(
        stream_in.valid_events(as_sent(lines)), f"{out}/data", f"{out}/checkpoint", bounded=True))
    return spark.read.parquet(f"{out}/data").select("transaction_id", "seq", "is_duplicate")


@query
def stream_late(spark, sf_dir):
    unique = replay.mark_repeats(stream(spark, sf_dir)).filter("NOT is_duplicate")
    late = replay.mark_late(unique.drop("is_duplicate")).filter("is_late")
    return shown(late.drop("is_late"))


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplied messages in three partitions, offsets counting up in each."""
    value = stream_in.json_line("transaction_id", "user_id", "amount", F.col("event_time").alias("timestamp"), "seq")
    return stream(spark, sf_dir).select(
        (F.col("seq") % 3).cast("string").alias("partition"), F.floor(F.col("seq") / 3).alias("offset"),
        F.col("ingested_at").alias("arrived_at"), value.alias("value"))


def _told(lines: DataFrame) -> DataFrame:
    return shown(lines.select("partition", "position", "arrived_at",
                              F.get_json_object("value", "$.transaction_id").alias("transaction_id")))


@query
def topic_bounded(spark, sf_dir):
    """A bounded read of exported segments: from given offsets up to given ones, per partition."""
    path = fresh_path(spark, "topic")
    export_topic(topic_messages(spark, sf_dir), path)
    return _told(topic_lines(spark, path, '{"0": 100, "2": 7}', '{"1": 500}'))


@query
def topic_resume(spark, sf_dir):
    """The topic live while segments are added; stopped after each round and resumed from its checkpoint."""
    path, out, checkpoint = (fresh_path(spark, x) for x in ("topic", "resumed", "resumed-checkpoint"))
    messages = written(topic_messages(spark, sf_dir), "messages")
    third = F.floor(F.col("offset") * 3 / (F.max("offset").over(Window.partitionBy("partition")) + 1))
    rounds = written(messages.withColumn("round", third), "rounds")
    for i in range(3):
        export_topic(rounds.filter(F.col("round") == i), path)
        jobs.to_table(topic_lines(spark, path, "earliest", streaming=True), out, checkpoint, bounded=True
                      ).awaitTermination()
    return _told(spark.read.parquet(out))


#: The supplied stream is thin: a partition's rows come minutes apart, so idleness is scaled likewise.
_IDLE = "20 minutes"


def dealt_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream from four source partitions: one is slow, and one falls silent after a week."""
    silent = (F.col("seq") % 4 == 3) & (F.col("ingested_at") >= F.lit("2024-01-08").cast("timestamp"))
    number = F.when(silent, 0).otherwise(F.col("seq") % 4)
    slow = F.when(number == 2, F.col("event_time") - F.expr("INTERVAL 25 minutes")).otherwise(F.col("event_time"))
    return stream(spark, sf_dir).withColumns({"partition": F.concat(F.lit("p"), number), "event_time": slow})


@query
def stream_late_partitions(spark, sf_dir):
    """Late rows by the least watermark of the partitions that are not idle."""
    marked, _ = watermarks.mark_late_by_source(dealt_stream(spark, sf_dir), idle=_IDLE)
    return shown(marked.filter("is_late").drop("is_late"))


@query
def stream_late_partitions_live(spark, sf_dir):
    """The same live in five micro-batches, each of which starts anew from the checkpoint."""
    root, sent = fresh_path(spark, "late-live"), fresh_path(spark, "late-sent")
    events = written(dealt_stream(spark, sf_dir), "dealt")
    first, last = events.agg(F.min(F.unix_micros("ingested_at")), F.max(F.unix_micros("ingested_at"))).first()
    fifth = F.floor((F.unix_micros("ingested_at") - F.lit(first)) * 5 / F.lit(last - first + 1))
    step = watermarks.late_batch(spark, root, idle=_IDLE)
    for i in range(5):
        events.filter(fifth == i).write.mode("append").parquet(sent)
        arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 10_000).parquet(sent)
        arriving.writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/_checkpoint").trigger(
            availableNow=True).start().awaitTermination()
        if i == 3:
            step(events.filter(fifth == i), i)
    marked = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/marked")
    return shown(marked.filter("is_late").drop("is_late"))


@query
def stream_features(spark, sf_dir):
    out = features.stream_features(replay.on_time(stream(spark, sf_dir)))
    return shown(out.withColumn("total_amount", cents(F.col("total_amount"))))


@cache
def _job(application: str, sf_dir: str) -> str:
    """The whole job over the raw JSON messages in five micro-batches; run once per session."""
    spark = SparkSession.active()
    root, source = fresh_path(spark, "job"), fresh_path(spark, "messages")
    clock = F.get_json_object("value", "$.ingested_at").try_cast("timestamp")
    first, last = json_lines(spark, sf_dir).agg(
        F.min(F.unix_micros(clock)), F.max(F.unix_micros(clock))).first()
    fifth = F.floor((F.unix_micros(clock) - F.lit(first)) * 5 / F.lit(last - first + 1))
    rounds = written(json_lines(spark, sf_dir).withColumn("round", fifth), "rounds")
    for i in range(5):
        # one file a round, so that files are taken in order of arrival
        part = rounds.filter(F.col("round") == i).select("value")
        if i == 1:  # and messages that were cut off on the way
            part = part.union(part.select(F.expr("substring(value, 1, length(value) - 1)")))
        part.coalesce(1).write.mode("append").text(source)
    lines = stream_in.file_lines(spark, source, files_per_batch=1)
    jobs.run_job(as_sent(lines), root, bounded=True, threshold=BUSY)
    return root


def job_output(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return jobs.job_output(spark, _job(spark.sparkContext.applicationId, sf_dir), name, BUSY)


@query
def stream_features_live(spark, sf_dir):
    """Live: all windows of the job, the late rows left out."""
    return shown(job_output(spark, sf_dir, "features").withColumn(
        "total_amount", cents(F.col("total_amount"))))


@query
def burst_monitor(spark, sf_dir):
    return shown(replay.burst_windows(stream(spark, sf_dir), BUSY))


@query
def burst_monitor_live(spark, sf_dir):
    """Live: all burst windows of the job."""
    return shown(job_output(spark, sf_dir, "bursts"))


@query
def stream_job(spark, sf_dir):
    """Live: the whole job over raw messages; rows per output, and the windows' counts and totals."""
    outputs: Mapping[str, DataFrame] = {
        "unique": job_output(spark, sf_dir, "marked").filter("NOT is_duplicate"),
        "duplicate": job_output(spark, sf_dir, "marked").filter("is_duplicate"),
        "late": job_output(spark, sf_dir, "late"),
        "features": job_output(spark, sf_dir, "features"),
        "feature_events": job_output(spark, sf_dir, "on_time"),
        "burst": job_output(spark, sf_dir, "bursts").filter("burst_detected"),
        "quarantine": job_output(spark, sf_dir, "quarantine")}
    counts = None
    for name, df in outputs.items():
        total = F.sum("total_amount") if name == "features" else F.lit(None).cast("double")
        row = df.agg(F.count(F.lit(1)).alias("row_count"), F.round(total, 1).alias("total")).select(
            F.lit(name).alias("output"), "row_count", "total")
        counts = row if counts is None else counts.unionByName(row)
    return counts


@query
def stream_dedup_identical(spark, sf_dir):
    """Messages resent exactly as they were, without any number of their own."""
    sent = stream(spark, sf_dir).filter("seq % 2 = 0")
    resent = sent.filter("seq % 134 = 0")
    return replay.mark_repeats(sent.union(resent).union(resent).drop("seq")).select(
        "transaction_id", "is_duplicate")


@query
def stream_dedup_long(spark, sf_dir):
    """Few ids that return for hours: each is new again 30 minutes after it was last new."""
    folded = stream(spark, sf_dir).withColumn(
        "transaction_id", F.concat(F.lit("k"), (F.col("seq") % 40).cast("string")))
    return replay.mark_repeats(folded).select("transaction_id", "seq", "is_duplicate")


@query
def tagged_output(spark, sf_dir):
    """The text lines of all four outputs."""
    events = stream(spark, sf_dir)
    marked = written(replay.mark_repeats(events).withColumn(
        "timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), "marked")
    judged = written(replay.mark_late(marked.filter("NOT is_duplicate")), "judged")
    return (
        jobs.tagged_lines(features.stream_features(judged.filter("NOT is_late")), "FEATURE")
        .unionByName(jobs.tagged_lines(replay.burst_windows(events, BUSY), "BURST"))
        .unionByName(jobs.tagged_lines(marked.filter("is_duplicate"), "DUPLICATE"))
        .unionByName(jobs.tagged_lines(judged.filter("is_late"), "LATE")))


@query
def stream_refinements_live(spark, sf_dir):
    """Live: windows as refined so far, here up to the end of the input."""
    source, out = fresh_path(spark, "on-time"), fresh_path(spark, "refined")
    timely = replay.on_time(stream(spark, sf_dir))
    timely.write.parquet(source)
    live = jobs.read_stored(spark, source, timely.schema)
    finish(jobs.run_refining(live, f"{out}/data", f"{out}/checkpoint", bounded=True))
    return shown(jobs.refined_features(spark, f"{out}/data").withColumn(
        "total_amount", cents(F.col("total_amount"))))


@query
def feat_stream_5m(spark, sf_dir):
    events = stream(spark, sf_dir)
    out = features.stream_features_with_burst(
        replay.on_time(events), replay.burst_windows(events, BUSY))
    return shown(out.withColumn(features.STREAM_TOTAL, cents(F.col(features.STREAM_TOTAL))))


@query
def feat_user_unified(spark, sf_dir):
    offline = features.user_features_90d(
        fact(spark, sf_dir), model.dim_user(silver(spark, sf_dir, "users")))
    events = stream(spark, sf_dir)
    windows = features.stream_features_with_burst(
        replay.on_time(events), replay.burst_windows(events, BUSY))
    windows = windows.withColumn(features.STREAM_TOTAL, cents(F.col(features.STREAM_TOTAL)))
    return rounded_features(features.unified_features(offline, windows))


@query
def point_in_time(spark, sf_dir):
    """Every arrival with the newest finished stream window of its user at that moment."""
    labels = stream(spark, sf_dir).select(
        "seq", "user_id", F.col("ingested_at").alias("label_time"))
    events = stream(spark, sf_dir)
    windows = written(features.stream_features(replay.on_time(events)).select(
        "user_id", F.col("window_end").alias("event_timestamp"),
        F.col("window_end").alias("created_timestamp"), "count",
        cents(F.col("total_amount")).alias("total_amount")), "feature-table")
    return shown(joins.as_of(
        labels, windows, "user_id", "label_time", "event_timestamp", "created_timestamp",
        ["count", "total_amount"]))


# --- Changes ----------------------------------------------------------------------------------


@query
def upsert(spark, sf_dir):
    """Cleaned transactions updated with the raw failed ones, which carry later versions."""
    current = silver(spark, sf_dir, "transactions").select(
        "transaction_id", "ingested_at", "status", "amount")
    updates = wallet(spark, sf_dir, "transactions").filter("status = 'failed'").select(
        "transaction_id", F.col("ingested_at"), F.lit("reversed").alias("status"), "amount")
    updates = dedup.keep_latest(updates, ["transaction_id"], ["ingested_at"])
    return shown(change.upserted(current, updates, ["transaction_id"], ["ingested_at"]))


@query
def upsert_partitions(spark, sf_dir):
    """The same in place: three months of a table partitioned by month are rewritten on disk."""
    path = fresh_path(spark, "upserted")
    tables.write_table(
        silver(spark, sf_dir, "transactions").select(
            "transaction_id", "ingested_at", "status", "amount",
            F.date_format("event_date", "yyyy-MM").alias("event_month")),
        path, partition_by=("event_month",))
    current = spark.read.schema(
        "transaction_id string, ingested_at timestamp, status string, amount double,"
        " event_month string").parquet(path)
    updates = current.filter(F.col("event_month").between("1997-01", "1997-03")).withColumn(
        "status", F.lit("reviewed"))
    change.upsert_partitions(
        current, updates, path, ["transaction_id"], ["ingested_at"], "event_month")
    spark.catalog.refreshByPath(path)
    return shown(spark.read.schema(current.schema).parquet(path))


@query
def cdc_apply(spark, sf_dir):
    """Envelopes as JSON text, decoded and applied."""
    log = wallet(spark, sf_dir, "change_log")
    row = F.struct("order_id", "account_id", "status", "amount")
    gone = F.col("op") == "d"
    envelope = F.to_json(F.struct(
        "op", F.struct(F.col("position").alias("lsn")).alias("source"),
        F.when(gone, row).alias("before"), F.when(~gone, row).alias("after")))
    changes = change.decode_changes(
        log.select(envelope.alias("value")),
        "order_id string, account_id string, status string, amount double")
    return change.apply_changes(changes, ["order_id"])


def envelopes(spark: SparkSession, sf_dir: str, amount: Column) -> DataFrame:
    """The change log as JSON text, with the amount as given."""
    row = F.struct("order_id", "account_id", "status", amount.alias("amount"))
    gone = F.col("op") == "d"
    return wallet(spark, sf_dir, "change_log").select(F.to_json(F.struct(
        "op", F.struct(F.col("position").alias("lsn")).alias("source"),
        F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"))).alias("value"))


_CHANGED = "order_id string, account_id string, status string, amount double"


@query
def cdc_encoded(spark, sf_dir):
    """Amounts as connectors send exact decimals without further settings: base64 of signed bytes."""
    unscaled = F.round(F.col("amount") * 100).cast("long") * F.when(F.col("position") % 2 == 0, 1).otherwise(-1)
    sent = F.base64(F.unhex(F.lpad(F.hex(unscaled), 16, "0")))
    tombstones = spark.createDataFrame([(None,)], "value string")
    lines = envelopes(spark, sf_dir, sent).union(tombstones)
    log = change.decode_changes(lines, _CHANGED, keys=["order_id"], decimals={"amount": 2})
    return change.apply_changes(log, ["order_id"])


@query
def cdc_quarantine(spark, sf_dir):
    """Envelopes cut off in transit, one in five, are set aside; the others are applied."""
    lines = envelopes(spark, sf_dir, F.col("amount"))
    cut = F.get_json_object("value", "$.source.lsn").cast("long") % 5 == 0
    lines = lines.select(F.when(cut, F.substring("value", 1, 40)).otherwise(F.col("value")).alias("value"))
    bad = change.malformed_changes(lines, _CHANGED, keys=["order_id"])
    good = change.apply_changes(change.decode_changes(lines, _CHANGED, keys=["order_id"]), ["order_id"])
    return bad.agg(F.lit("quarantine").alias("output"), F.count(F.lit(1)).alias("row_count")).unionByName(
        good.agg(F.lit("applied").alias("output"), F.count(F.lit(1)).alias("row_count")))


_EXACT = "order_id string, account_id string, status string, amount decimal(18,2), changed_at timestamp"


def typed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log with `schema` blocks: exact decimals as bytes, clocks in micro- or milliseconds.

    Amounts come in as few bytes as they need, or in 8; half are negative, and some are far beyond
    what a double holds. Every seventh cannot be read. `position` is kept beside the text.
    """
    log = wallet(spark, sf_dir, "change_log")
    cents = F.round(F.col("amount") * 100).cast("long") * F.when(F.col("position") % 2 == 0, 1).otherwise(-1)
    cents = F.when(F.col("position") % 11 == 0, F.lit(999_999_999_999_999_999)).otherwise(cents)
    digits = F.lpad(F.hex(cents), 16, "0")
    short = F.when(cents < 0, F.regexp_replace(digits, "^(FF)+(?=[89A-F])", "")).otherwise(
        F.regexp_replace(digits, "^(00)+(?=[0-7])", ""))
    sent = F.when(F.col("position") % 7 == 0, F.lit("###")).otherwise(
        F.base64(F.unhex(F.when(F.col("position") % 3 == 0, digits).otherwise(short))))
    fine = F.col("position") % 5 == 0
    at = F.when(fine, F.col("position") * 1_000_000).otherwise(F.col("position") * 1000)
    row = F.struct("order_id", "account_id", "status", sent.alias("amount"), at.alias("changed_at"))
    gone = F.col("op") == "d"
    payload = F.to_json(F.struct(
        "op", F.struct(F.col("position").alias("lsn")).alias("source"),
        F.when(gone, row).alias("before"), F.when(~gone, row).alias("after")))

    def block(clock: str) -> str:
        columns = ('[{"type":"string","field":"order_id"},{"type":"bytes","name":"%s","parameters":'
                   '{"scale":"2","connect.decimal.precision":"18"},"field":"amount"},'
                   '{"type":"int64","name":"%s","field":"changed_at"}]' % (change.DECIMAL, clock))
        return ('{"type":"struct","fields":[{"type":"struct","fields":%s,"field":"before"},'
                '{"type":"struct","fields":%s,"field":"after"}]}' % (columns, columns))
    schema = F.when(fine, block(change.CLOCKS["micros"][0])).otherwise(block(change.CLOCKS["millis"][0]))
    return log.select("position", F.concat(
        F.lit('{"schema":'), schema, F.lit(',"payload":'), payload, F.lit("}")).alias("value"))


def exact(df: DataFrame) -> DataFrame:
    return shown(df.withColumn("amount", F.col("amount").cast("string")))


@query
def cdc_typed(spark, sf_dir):
    """Decoding by the envelopes' own schema, exact to the last cent; unreadable amounts do not count."""
    log = change.decode_changes(typed_envelopes(spark, sf_dir), _EXACT, keys=["order_id"])
    return exact(change.apply_changes(log, ["order_id"]))


@query
def cdc_unreadable(spark, sf_dir):
    """Envelopes whose amount cannot be read, by their position."""
    bad = change.malformed_changes(typed_envelopes(spark, sf_dir), _EXACT, keys=["order_id"])
    return bad.select(F.get_json_object("value", "$.payload.source.lsn").cast("long").alias("position"))


@query
def cdc_live(spark, sf_dir):
    """The same log live, in five micro-batches that are out of order, the third of them run again.

    Each round starts the job anew from its checkpoint. Envelopes are made as they are sent, compressed: as
    plain text they take many times the disk of the orders they come from.
    """
    root, sent = fresh_path(spark, "live-changes"), fresh_path(spark, "sent-changes")
    lines = typed_envelopes(spark, sf_dir)
    table = LiveTable(spark, root, _EXACT, ["order_id"], buckets=8)
    for i in range(5):
        batch = lines.filter(F.pmod(F.xxhash64("position"), F.lit(5)) == i).select("value")
        (batch.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", LINES_SENT)
         .text(sent))
        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 10_000).text(sent)
        table.start(stream, bounded=True).awaitTermination()
        if i == 2:
            table.apply(batch, i)
    return exact(table.read())


@query
def upsert_null_key(spark, sf_dir):
    """Updates without the amount leave it as it is, also where the key is NULL."""
    rows = dedup.keep_latest(silver(spark, sf_dir, "transactions"), ["transaction_id"], ["ingested_at"])
    current = rows.select(F.nullif(F.col("channel"), F.lit("UNKNOWN")).alias("channel"), "ingested_at",
                          "status", "amount", "transaction_id")
    current = dedup.keep_latest(current, ["channel"], ["ingested_at", "transaction_id"])
    updates = current.select("channel", "ingested_at", F.lit("reversed").alias("status"))
    return shown(change.upserted(current, updates, ["channel"], ["ingested_at"]))


@query
def upsert_partial(spark, sf_dir):
    """Updates without the amount leave it as it is."""
    current = dedup.keep_latest(silver(spark, sf_dir, "transactions"), ["transaction_id"], ["ingested_at"]).select(
        "transaction_id", "ingested_at", "status", "amount")
    updates = current.filter("status = 'failed'").select(
        "transaction_id", "ingested_at", F.lit("reversed").alias("status"))
    return shown(change.upserted(current, updates, ["transaction_id"], ["ingested_at"]))


@query
def upsert_null_partition(spark, sf_dir):
    """In place where a partition has no value: rows of it that no update names stay."""
    path = fresh_path(spark, "upserted-null")
    rows = silver(spark, sf_dir, "transactions").select("transaction_id", "ingested_at", "amount", "channel")
    rows = rows.withColumn("channel", F.when(F.col("channel") != "UNKNOWN", F.col("channel")))
    tables.write_table(rows, path, partition_by=("channel",))
    current = spark.read.schema(rows.schema).parquet(path)
    updates = current.filter("transaction_id LIKE '%1' AND (channel IS NULL OR channel = 'app')").withColumn(
        "amount", F.lit(1.0))
    change.upsert_partitions(current, updates, path, ["transaction_id"], ["ingested_at"], "channel",
                             check_moves=True)
    spark.catalog.refreshByPath(path)
    return shown(spark.read.schema(rows.schema).parquet(path))


def _versioned(spark: SparkSession, sf_dir: str, rows_per_task: int) -> DataFrame:
    """Orders with the last price that their customer's line items had by then, several versions each."""
    labels = raw(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_custkey") % 20, F.lit(0)).alias("k"),
        F.col("o_orderdate").cast("timestamp").alias("label_time"))
    priced = raw(spark, sf_dir, "orders").join(
        raw(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    made = F.nullif(F.col("l_linenumber") % 4, F.lit(0))
    features_ = priced.select(
        (F.col("o_custkey") % 20).alias("k"), F.date_trunc("month", "l_shipdate").cast("timestamp").alias("at"),
        made.alias("version"), F.col("l_extendedprice").alias("price"))
    return shown(joins.as_of(labels, features_, "k", "label_time", "at", "version", ["price"],
                             slice_by="year", rows_per_task=rows_per_task))


@query
def point_in_time_versions(spark, sf_dir):
    """Several versions of a feature at one time, missing versions and keys included."""
    return _versioned(spark, sf_dir, 1_000_000)


@query
def point_in_time_dealt(spark, sf_dir):
    """The same with each slice's labels dealt out to many tasks."""
    return _versioned(spark, sf_dir, 3)
