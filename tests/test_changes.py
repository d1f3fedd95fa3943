import base64
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import change
from ledgerlake.sources.folders import names
from ledgerlake.sources.workspace import shared_folder
from ledgerlake.streaming.changes import LiveTable

ROW = "id string, n decimal(18,2), at timestamp"


def encoded(number: int, length: int | None = None) -> str:
    n = length or number.bit_length() // 8 + 1
    return base64.b64encode(number.to_bytes(n, "big", signed=True)).decode()


def line(lsn, key, n, op="c", **more):
    row = {"id": key, "n": n, **more}
    return json.dumps({"op": op, "source": {"lsn": lsn}, ("before" if op == "d" else "after"): row})


def frame(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


@pytest.mark.parametrize("scale", [0, 2, 10])
def test_unscaled_numbers_are_exact(spark, scale):
    numbers = [0, 1, -1, 127, 128, -128, -129, -2658824, 10**18 - 1, -(10**18), 2**63, -(2**63), 10**37, -(10**37) + 7]
    rows = [(encoded(n), n) for n in numbers] + [(encoded(n, 16), n) for n in numbers]
    df = spark.createDataFrame([(t, str(n)) for t, n in rows], "t string, n string")
    got = df.select(change.unscaled_text(F.col("t"), F.lit(scale)).alias("x"), "n").collect()
    assert all(Decimal(r.x) == Decimal(r.n).scaleb(-scale) for r in got)
    bad = frame(spark, ["###", "abc", "12.5", "", None, "AAAA" * 20])
    assert {r[0] for r in bad.select(change.unscaled_text(F.col("value"), F.lit(2))).collect()} == {None}


def test_texts_that_look_like_numbers_are_decoded(spark):
    text = base64.b64encode((-2658824).to_bytes(3, "big", signed=True)).decode()
    lines = [line(1, "a", text), line(2, "b", "1234"), line(3, "c", encoded(999_999_999_999_999_999)),
             line(4, "d", "###"), line(5, "e", encoded(10**20)), line(6, "f", None)]
    df = frame(spark, lines)
    got = {r.id: r.n for r in change.decode_changes(df, ROW, keys=["id"], decimals={"n": 2}).collect()}
    want = Decimal(int.from_bytes(base64.b64decode("1234"), "big", signed=True)).scaleb(-2)
    assert got == {"a": Decimal("-26588.24"), "b": want, "c": Decimal("9999999999999999.99"), "f": None}
    bad = change.malformed_changes(df, ROW, keys=["id"], decimals={"n": 2})
    assert sorted(r.value for r in bad.collect()) == [lines[3], lines[4]]


def test_a_schema_block_decides(spark):
    def block(name, clock):
        fields = [{"field": "id", "type": "string"}, {"field": "n", "name": name, "parameters": {"scale": "1"}},
                  {"field": "at", "name": clock}]
        return {"fields": [{"field": "before", "fields": fields}, {"field": "after", "fields": fields}]}

    def sent(schema, text):
        return json.dumps({"schema": schema, "payload": json.loads(text)})
    micros, millis = change.CLOCKS["micros"][0], change.CLOCKS["millis"][1]
    lines = [sent(block(change.DECIMAL, micros), line(1, "a", encoded(-15), at=1_500_000)),
             sent(block(None, millis), line(2, "b", "2.25", at=1500)),
             sent(block(change.DECIMAL, change.DAYS[0]), line(3, "c", encoded(7), op="d", at=1)),
             sent(block(change.DECIMAL, micros), line(4, "d", "2.25")),
             line(5, "e", 3.5, at="1970-01-01T00:00:02Z"), line(6, "f", True)]
    df = frame(spark, lines)
    got = {r.id: (r.op, r.n, r.at and r.at.timestamp()) for r in change.decode_changes(df, ROW, keys=["id"]).collect()}
    assert got == {"a": ("c", Decimal("-1.50"), 1.5), "b": ("c", Decimal("2.25"), 1.5), "c": ("d", Decimal("0.70"), 86400.0),
                   "e": ("c", Decimal("3.50"), 2.0)}
    bad = change.malformed_changes(df, ROW, keys=["id"])
    assert sorted(r.value for r in bad.collect()) == sorted([lines[3], lines[5]])


def test_each_text_is_parsed_once(spark, plan_of):
    df = frame(spark, [line(1, "a", 1)])
    plan = plan_of(change.decode_changes(df, ROW, keys=["id"]))
    assert plan.count("from_json(StructField(op") <= 4  # twice as executed, twice in the details


def test_upserts_keep_omitted_columns_of_a_null_key(spark):
    current = spark.createDataFrame([(None, 1, 5.0), ("a", 1, 6.0)], "k string, v int, amt double")
    updates = spark.createDataFrame([(None, 2), ("a", 2), ("b", 2)], "k string, v int")
    got = {r.k: (r.v, r.amt) for r in change.upserted(current, updates, ["k"], ["v"]).collect()}
    assert got == {None: (2, 5.0), "a": (2, 6.0), "b": (2, None)}


def test_live_table_survives_restarts_replays_and_late_changes(spark, tmp_path):
    root, sent = str(tmp_path / "t"), str(tmp_path / "in")
    table = LiveTable(spark, root, ROW, ["id"], buckets=4, kept=2, decimals={"n": 2})
    rounds = [[line(3, "a", encoded(300)), line(1, "b", encoded(100)), "broken"],
              [line(2, "a", encoded(200)), line(5, "b", encoded(500), op="d")],
              [line(4, "b", encoded(400), op="u"), line(6, "c", "###"), line(7, "c", encoded(700))],
              [line(8, "d", encoded(800))], [line(9, "d", encoded(900), op="u")]]
    for i, lines in enumerate(rounds):
        frame(spark, lines).coalesce(1).write.mode("append").text(sent)
        stream = spark.readStream.schema("value string").text(sent)
        table.start(stream, bounded=True).awaitTermination()
        if i in (1, 4):  # run again
            table.apply(frame(spark, lines), i)
    assert {r.id: r.n for r in table.read().collect()} == {
        "a": Decimal("3.00"), "c": Decimal("7.00"), "d": Decimal("9.00")}
    assert sorted(r.value for r in table.quarantined().collect()) == sorted(["broken", rounds[2][1]])
    assert len(names(spark, f"{root}/manifests")) == 2
    assert len(names(spark, f"{root}/rows")) <= 4  # one for each bucket at most


def test_a_batch_that_failed_halfway_is_not_seen(spark, tmp_path, monkeypatch):
    table = LiveTable(spark, str(tmp_path / "t"), ROW, ["id"], buckets=2)
    table.apply(frame(spark, [line(1, "a", 1)]), 0)
    with monkeypatch.context() as m:
        m.setattr(table, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.apply(frame(spark, [line(2, "a", 2)]), 1)
    assert [r.n for r in table.read().collect()] == [Decimal("1.00")]
    table.apply(frame(spark, [line(2, "a", 2)]), 1)
    assert [r.n for r in table.read().collect()] == [Decimal("2.00")]
    assert LiveTable(spark, str(tmp_path / "new"), ROW, ["id"]).read().collect() == []


def test_a_batch_writes_what_it_brings_until_folders_are_merged(spark, tmp_path):
    root = str(tmp_path / "t")
    table = LiveTable(spark, root, ROW, ["id"], buckets=6, kept=1)
    for i in range(4):
        table.apply(frame(spark, [line(10 + i, f"k{i}", i + 1), line(i + 1, "k0", 90 + i)]), i)
    held = [spark.read.schema(table.stored).parquet(f"{root}/rows/{n}").count() for n in names(spark, f"{root}/rows")]
    assert held == [1, 2, 2, 2]
    for i in range(4, 30):
        table.apply(frame(spark, [line(10 + i, f"k{i % 5}", i + 1)]), i)
        assert len(names(spark, f"{root}/rows")) <= 6
    assert {r.id: int(r.n) for r in table.read().collect()} == {f"k{i}": 26 + i for i in range(5)}


def test_a_batch_leaves_rows_and_compressed_text(spark, tmp_path, monkeypatch):
    before, root = names(spark, f"{shared_folder(spark)}/ledgerlake"), str(tmp_path / "t")
    table = LiveTable(spark, root, ROW, ["id"], buckets=2)
    lines = [line(i, f"k{i}", "###", about="fields " * 50) for i in range(200)]
    table.apply(frame(spark, [*lines, line(200, "a", 2)]).coalesce(1), 0)
    with monkeypatch.context() as m:
        m.setattr(table, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.apply(frame(spark, [line(201, "a", 3)]), 1)
    assert names(spark, f"{shared_folder(spark)}/ledgerlake") == before
    assert sum(f.stat().st_size for f in tmp_path.glob("t/quarantine/*/part-*")) < sum(map(len, lines)) / 4
    assert sorted(r.value for r in table.quarantined().collect()) == sorted(lines)
    assert [int(r.n) for r in table.read().collect()] == [2]
