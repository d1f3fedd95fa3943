import pytest
from pyspark.sql import functions as F

from ledgerlake import config
from ledgerlake.sources import catalog, layout, tables
from ledgerlake.sources.workspace import shared_folder


def merchants(spark, n=3):
    return spark.range(n).selectExpr("concat('m', id) merchant_id", "'x' merchant_name",
                                     "'grocery' category")


def test_missing_columns_are_named_in_order(spark):
    with pytest.raises(tables.IngestError, match="lacks expected columns: category, merchant_name"):
        tables.normalize_bronze(spark.range(1).selectExpr("'m' merchant_id"), "merchants")


def test_bronze_only_casts(spark):
    df = spark.createDataFrame([(1, "2024-01-01", None, 5)],
                               "account_id long, snapshot_date string, extra string,"
                               " closing_balance long")
    out = tables.normalize_bronze(df, "balance_snapshots")
    assert dict(out.dtypes) == {"account_id": "string", "snapshot_date": "date",
                                "extra": "string", "closing_balance": "bigint"}
    bad = df.withColumn("snapshot_date", F.lit("no date"))
    with pytest.raises(Exception, match="no date"):
        tables.normalize_bronze(bad, "balance_snapshots").collect()


def test_write_modes_and_verification(spark, tmp_path):
    path = str(tmp_path / "m")
    assert tables.write_verified(merchants(spark), "merchants", path).target_rows == 3
    assert tables.write_verified(merchants(spark, 2), "merchants", path,
                                 mode="append").target_rows == 5
    assert tables.write_verified(merchants(spark, 1), "merchants", path).target_rows == 1
    with pytest.raises(ValueError):
        tables.write_verified(merchants(spark), "merchants", path, mode="ignore")


def test_ingest_selection():
    assert tables.selected_tables(None) == list(config.TABLES)
    assert tables.selected_tables(["users", "merchants", "users"]) == ["users", "merchants"]
    with pytest.raises(tables.IngestError, match="unknown tables: a, z"):
        tables.selected_tables(["z", "users", "a"])


def test_ingest_stops_or_goes_on(spark, tmp_path):
    def source(name):
        if name == "users":
            raise OSError("gone")
        return merchants(spark)

    lake = config.Lakehouse(str(tmp_path))
    wanted = ["users", "merchants"]
    stopped = tables.ingest(spark, lake, source, wanted).collect()
    assert [(r.table_name, r.error) for r in stopped] == [("users", "gone")]
    went_on = tables.ingest(spark, lake, source, wanted, continue_on_error=True,
                            database="ingest_test").collect()
    assert [(r.table_name, r.target_rows, r.catalog_rows, r.registered_now) for r in went_on] == [
        ("users", None, None, None), ("merchants", 3, 3, True)]
    assert spark.table("ingest_test.merchants").count() == 3


def test_registration_is_idempotent_and_verified(spark, tmp_path):
    path = str(tmp_path / "logins")
    spark.range(4).selectExpr("id", "id % 2 p").write.partitionBy("p").parquet(path)
    first = catalog.register_verified(spark, "catalog_test", "logins", path, expected_rows=4)
    again = catalog.register_verified(spark, "catalog_test", "logins", path)
    assert (first.registered_now, again.registered_now, again.row_count) == (True, False, 4)
    with pytest.raises(catalog.CatalogError, match="expected 5"):
        catalog.register_verified(spark, "catalog_test", "logins", path, expected_rows=5)


def test_partition_pruning_and_column_pruning_reach_the_scan(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    tables.write_table(
        spark.range(100).selectExpr("id", "id * 2 v", "date_add(date'2024-01-01', int(id % 5)) d"),
        path, partition_by=["d"])
    plan = plan_of(spark.read.parquet(path).filter("d = '2024-01-02'").select("v"))
    assert "PartitionFilters: [isnotnull(d" in plan and "ReadSchema: struct<v:bigint>" in plan
    pruned = plan_of(tables.read_present(spark.read.parquet(path), "v"))
    assert "PushedFilters: [IsNotNull(v)]" in pruned and "ReadSchema: struct<v:bigint>" in pruned


def test_partitioned_writes_make_one_file_per_small_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(0, 1000, 1, 16).selectExpr("id", "id % 3 p"), path,
                       partition_by=["p"])
    report = layout.layout_report(spark.read.parquet(path), "t").first()
    assert (report.file_count, report.row_count, report.table_name) == (3, 1000, "t")


def test_a_skewed_partition_is_split_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 200_000, 1, 8).selectExpr(
            "id", "uuid() u", "case when id % 3 = 0 then id % 50 else 0 end p")
        tables.write_table(df, path, partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).filter("p = 0").select("_metadata.file_path").distinct()
    assert files.count() > 3
    assert spark.read.parquet(path).count() == 200_000


def test_compaction_keeps_the_rows_in_fewer_files(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(0, 100, 1, 20).write.parquet(source)
    layout.compact(spark, source, target)
    before, after = (layout.layout_report(spark.read.parquet(p), p).first()
                     for p in (source, target))
    assert (before.file_count, after.file_count) == (20, 1)
    assert before.row_count == after.row_count == 100


def test_merged_schema_shows_new_columns_as_null(spark, tmp_path):
    lake = config.Lakehouse(str(tmp_path))
    tables.write_table(spark.range(1), lake.path("bronze", "t") + "/part=1")
    tables.write_table(spark.range(1).selectExpr("id", "'x' c"), lake.path("bronze", "t") + "/part=2")
    got = tables.read_table(spark, lake, "bronze", "t", merge_schema=True)
    assert sorted(((r.part, r.c) for r in got.collect()), key=str) == [(1, None), (2, "x")]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
