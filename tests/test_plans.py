"""The jobs end to end, and the shapes their plans must keep at scale."""

import json

import pytest

from ledgerlake import config
from ledgerlake.__main__ import arguments, run
from ledgerlake.checks.queries import QUERIES, fact, stream
from ledgerlake.operators import dedup, features, merchants, profile
from ledgerlake.operators import quality as dq
from ledgerlake.plans import gold, measure, silver, validate
from ledgerlake.sources.supplied import wallet
from ledgerlake.sources.tables import ingest_all, read_table
from ledgerlake.sources.workspace import written
from ledgerlake.streaming import replay

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """A lake filled by the whole pipeline. Dates are cut to one month so it has few folders."""
    root = config.Lakehouse(str(tmp_path_factory.mktemp("lake")))
    recent = {"transactions": "date_trunc('month', timestamp) = '1998-03-01'",
              "balance_snapshots": "date_trunc('month', snapshot_date) = '1998-03-01'"}
    done = ingest_all(
        spark, root, lambda t: wallet(spark, SF, t).filter(recent.get(t, "true")))
    assert [d.table for d in done] == list(config.TABLES)
    counts = {r.table_name: r for r in silver.run_silver(spark, root).collect()}
    assert counts["transactions"].removed_rows > 0 and counts["users"].removed_rows == 0
    gold.run_gold(spark, root)
    return root


def test_layers_pass_validation(spark, lake):
    assert len(validate.validate_silver(spark, lake)) == 27
    assert len(validate.validate_gold(spark, lake)) == 52


def test_gold_from_files_equals_gold_from_plans(spark, lake):
    tables = {t: read_table(spark, lake, "silver", t) for t in ("transactions", "users")}
    want = features.user_features_90d(tables["transactions"], tables["users"])
    got = read_table(spark, lake, "gold", "feat_user_90d")
    assert sorted(map(str, got.drop("created_timestamp").collect())) == sorted(
        map(str, want.drop("created_timestamp").collect()))


def test_validation_fails_on_a_damaged_layer(spark, lake):
    good = read_table(spark, lake, "silver", "users")
    with pytest.raises(dq.DataQualityError, match="duplicate_key"):
        dq.gate(dq.table_report(good.unionByName(good), dq.silver_rules()["users"]))


def test_a_failing_gate_leaves_the_old_table(spark, tmp_path, transactions):
    lake = config.Lakehouse(str(tmp_path))
    transactions({}).write.parquet(lake.path("bronze", "transactions"))
    silver.run_silver(spark, lake, ["transactions"])
    transactions({"amount": -1.0}).write.mode("overwrite").parquet(
        lake.path("bronze", "transactions"))
    spark.catalog.refreshByPath(lake.path("bronze", "transactions"))
    with pytest.raises(dq.DataQualityError, match="non_empty"):
        silver.run_silver(spark, lake, ["transactions"])
    assert read_table(spark, lake, "silver", "transactions").count() == 1


def test_measurements_agree_across_modes(spark, lake):
    tables = [read_table(spark, lake, "silver", t) for t in ("transactions", "merchants")]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    off = measure.merchant_benchmark(spark, *tables, "baseline")
    on = measure.merchant_benchmark(spark, *tables, "optimized")
    assert {k: v for k, v in off.items() if k not in ("mode", "seconds", "total_amount")} == {
        k: v for k, v in on.items() if k not in ("mode", "seconds", "total_amount")}
    assert off["total_amount"] == pytest.approx(on["total_amount"])
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
    out = measure.distinct_benchmark(spark, tables[0])
    assert out["exact_count"] == tables[0].count() and out["relative_error_pct"] < 15


def test_command_line_jobs(spark, lake, tmp_path, capsys):
    def call(*argv):
        return run(arguments().parse_args(["--root", lake.root, *argv]), spark)

    assert call("validate-silver") == 0
    assert call("layout") == 0
    assert call("distinct") == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["exact_count"] > 0
    assert call("bronze", "--source", SF, "--supplied", "--tables", "merchants") == 0
    assert call("bronze", "--source", str(tmp_path), "--tables", "merchants") == 1


# --- Plan shapes ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stored(spark):
    return {t: written(wallet(spark, SF, t), t) for t in ("transactions", "merchants", "users")}


def test_dedup_limits_each_key_before_the_shuffle(stored, plan_of):
    plan = plan_of(dedup.keep_latest(stored["transactions"], ["transaction_id"], ["ingested_at"]),
                   run=False)
    assert plan.count("WindowGroupLimit") >= 2 and plan.count("Exchange") >= 1
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def test_rules_of_a_table_take_one_scan(stored, plan_of):
    plan = plan_of(dq.table_report(stored["transactions"], dq.silver_rules()["transactions"]),
                   run=False)
    tree = plan.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") == 2


def test_workload_reads_three_columns_and_aggregates_before_the_join(stored, plan_of):
    plan = plan_of(merchants.merchant_workload(stored["transactions"], stored["merchants"]),
                   run=False)
    assert "ReadSchema: struct<status:string,amount:double,merchant_id:string>" in plan or \
        "ReadSchema: struct<amount:double,status:string,merchant_id:string>" in plan
    assert "PushedFilters: [IsNotNull(merchant_id)]" in plan


def test_no_query_uses_a_product_of_tables(spark, plan_of):
    for name in ("feat_user_90d", "obt", "merchant_skew_profile", "hour_skew", "stream_late",
                 "point_in_time", "dq_row_counts", "feat_stream_5m", "fk_orphans"):
        plan = plan_of(QUERIES[name](spark, SF), run=False)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_feature_bounds_prune_date_partitions(spark, tmp_path, plan_of, transactions, at):
    path = str(tmp_path / "fact")
    fact_rows = transactions(*[{"transaction_id": str(d), "timestamp": at("10:00:00", day=d)}
                               for d in range(1, 10)])
    fact_rows.selectExpr("*", "to_date(timestamp) event_date").write.partitionBy(
        "event_date").parquet(path)
    users = fact_rows.select("user_id").distinct()
    df = features.user_features_90d(spark.read.parquet(path), users, days=2)
    assert df.first()[features.TOTAL] == 3
    assert "PartitionFilters: [isnotnull(event_date" in plan_of(df)


def test_joins_stay_correct_without_any_broadcast(spark):
    names = ("obt", "merchant_performance", "feat_user_90d", "stream_late", "point_in_time")
    before = {n: sorted(map(str, QUERIES[n](spark, SF).collect())) for n in names}
    options = ("spark.sql.autoBroadcastJoinThreshold",
               "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for o in options:
        spark.conf.set(o, "-1")
    try:
        for n in names:
            assert sorted(map(str, QUERIES[n](spark, SF).collect())) == before[n], n
    finally:
        for o in options:
            spark.conf.unset(o)


def test_one_hot_key_with_half_of_all_rows(spark):
    """A hot transaction id, merchant and user at once; results must stay whole."""
    tx = fact(spark, SF)
    n = tx.count()
    hot = tx.unionByName(tx.selectExpr(*[
        {"transaction_id": "'hot' transaction_id", "merchant_id": "'0' merchant_id",
         "user_id": "'1' user_id"}.get(c, f"`{c}`") for c in tx.columns]))
    assert dedup.keep_latest(hot, ["transaction_id"], ["ingested_at"]).count() == n + 1
    assert dedup.repeat_stats(hot, "transaction_id").first().duplicate_rows == n - 1
    assert profile.skew_profile(hot, "merchant_id").first().max_rows >= n
    events = stream(spark, SF)
    copies = events.unionByName(events.selectExpr(*[
        "'hot' transaction_id" if c == "transaction_id" else c for c in events.columns]))
    marked = replay.mark_repeats(copies)
    assert marked.count() == 2 * events.count()
    assert marked.filter("transaction_id = 'hot' AND NOT is_duplicate").count() > 1
