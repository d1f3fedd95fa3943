"""Queries whose work must not grow faster than their input, on rows of their own."""

import datetime as dt
from pathlib import Path

import pytest

from ledgerlake.checks import queries
from ledgerlake.sources.folders import names
from ledgerlake.sources.workspace import shared_folder


@pytest.fixture
def folder(spark, tmp_path):
    day = dt.datetime(1995, 2, 1)
    lines = [(i, 1 + i % 4, i % 7, i % 5, 10.0 + i, 100.0 + i, "ANR"[i % 3], day + dt.timedelta(days=i % 40))
             for i in range(400)]
    orders = [(i, i % 9, "OFP"[i % 3], "1-URGENT", 5.0, day) for i in range(400)]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double,"
                            " l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string,"
                           " o_totalprice double, o_orderdate timestamp_ntz"),
        "customer": ([(i, 1.0) for i in range(9)], "c_custkey long, c_acctbal double")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_cardinality_reads_the_tables_once(spark, folder):
    out = queries.cardinality_incremental(spark, folder)
    assert not [f for f in out.inputFiles() if "lineitem" in f]
    exact = {r.column_name: r.exact_distinct for r in out.filter("days = 'all'").collect()}
    assert exact == {"transaction_id": 400, "account_id": 9, "merchant_id": 5, "type": 5}


def test_large_files_hold_a_bounded_number_of_lines(spark, folder, monkeypatch):
    written, compact = [], queries.compact_small
    monkeypatch.setattr(queries, "LINES_A_FILE", 100)
    monkeypatch.setattr(queries, "compact_small", lambda spark, root, *args: (
        written.append(spark.read.parquet(f"{root}/data").filter("l_orderkey % 2 = 0").groupBy(
            queries.file_name()).count().agg({"count": "max"}).first()[0]),
        compact(spark, root, *args)))
    out = queries.compaction_selective(spark, folder).collect()
    assert sum(r.n for r in out) == 400 and all(r.large_kept for r in out)
    assert written and written[0] <= 100 // 3 + 3


def test_a_live_log_is_stored_once_and_compressed(spark, folder, monkeypatch):
    shared = f"{shared_folder(spark)}/ledgerlake"
    before = set(names(spark, shared))
    monkeypatch.setattr(queries, "LINES_SENT", 20)
    out = sorted(map(str, queries.cdc_live(spark, folder).collect()))
    assert out == sorted(map(str, queries.cdc_typed(spark, folder).collect())) and out
    kept = {n.rsplit("-", 1)[0][:12]: n for n in set(names(spark, shared)) - before}
    assert sorted(kept) == ["live-changes", "sent-changes"]
    lines = queries.typed_envelopes(spark, folder).select("value")
    sent = spark.read.text(f"{shared}/{kept['sent-changes']}")
    assert not sent.exceptAll(lines).count() and not lines.exceptAll(sent).count()
    assert sent.groupBy(queries.file_name()).count().agg({"count": "max"}).first()[0] <= 20
    on_disk = sum(f.stat().st_size for f in Path(shared).rglob("part-*") if any(n in f.parts for n in kept.values()))
    assert on_disk < sum(len(r.value) for r in lines.collect()) / 2
