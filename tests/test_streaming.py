import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.features import stream_features
from ledgerlake.streaming import events as stream_in
from ledgerlake.streaming import jobs, replay

SCHEMA = ("seq long, transaction_id string, user_id string, amount double, event_time timestamp,"
          " ingested_at timestamp")
START = dt.datetime(2024, 1, 1)
SEC, MIN = dt.timedelta(seconds=1), dt.timedelta(minutes=1)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_stream(seed, n=300, ids=40, jitter_minutes=30):
    rng = random.Random(seed)
    rows, clock = [], START
    for seq in range(n):
        clock += dt.timedelta(seconds=rng.choice([0, 0, 1, 20, 400]))
        event = clock - dt.timedelta(seconds=rng.choice([0, 0, 0, rng.randint(0, 60 * jitter_minutes)]))
        rows.append((seq, f"t{rng.randint(0, ids)}", f"u{seq % 3}", float(rng.randint(1, 9)),
                     event, clock))
    return rows


def chained_repeats(rows, ttl=30 * MIN):
    """Straight from the definition, one row after the other."""
    first, flags = {}, {}
    for r in sorted(rows, key=lambda r: (r[5], r[0])):
        known = r[1] in first and r[5] <= first[r[1]] + ttl
        flags[r[0]] = known
        if not known:
            first[r[1]] = r[5]
    return flags


def late_by_definition(rows):
    flags, top = {}, None
    for r in sorted(rows, key=lambda r: (r[5], r[0])):
        end = r[4] - (r[4] - START) % (5 * MIN) + 5 * MIN
        flags[r[0]] = top is not None and top >= end + 70 * SEC
        top = r[4] if top is None else max(top, r[4])
    return flags


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_match_the_definition_over_many_rounds(spark, seed):
    rows = random_stream(seed)
    got = {r.seq: r.is_duplicate for r in replay.mark_repeats(frame(spark, rows)).collect()}
    assert got == chained_repeats(rows)


def test_ttl_boundary(spark):
    rows = [(0, "a", "u", 1.0, START, START),
            (1, "a", "u", 1.0, START, START + 30 * MIN - SEC),
            (2, "a", "u", 1.0, START, START + 30 * MIN + SEC)]
    got = {r.seq: r.is_duplicate for r in replay.mark_repeats(frame(spark, rows)).collect()}
    assert got == {0: False, 1: True, 2: False}


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_late_rows_match_the_definition(spark, seed):
    rows = random_stream(seed, ids=10**6)
    got = {r.seq: r.is_late for r in replay.mark_late(frame(spark, rows)).collect()}
    want = late_by_definition(rows)
    assert got == want and any(want.values())


@pytest.mark.parametrize("top, late", [(370 * SEC, True), (370 * SEC - MIN / 60000, False)])
def test_late_boundary(spark, top, late):
    rows = [(0, "a", "u", 1.0, START + top, START), (1, "b", "u", 1.0, START + MIN, START + SEC)]
    got = {r.seq: r.is_late for r in replay.mark_late(frame(spark, rows)).collect()}
    assert got == {0: False, 1: late}


def marked(spark, rows):
    df = frame(spark, rows)
    return df.select(*df.columns, F.col("ingested_at").alias("arrived_at"), F.lit("0").alias("partition"),
                     F.col("seq").alias("position"), F.lit(False).alias("is_duplicate"))


@pytest.mark.parametrize("batches", [1, 5, 20])
def test_the_job_does_not_depend_on_batches(spark, tmp_path, batches):
    rows = sorted(random_stream(7, ids=10**6), key=lambda r: (r[5], r[0]))
    step = jobs.job_batch(spark, str(tmp_path))
    size = -(-len(rows) // batches)
    for batch in range(batches):
        for _ in range(2 if batches == 5 else 1):  # a repeated batch must not change anything
            step(marked(spark, rows[batch * size:(batch + 1) * size]), batch)
    got = {r.seq for r in jobs.job_output(spark, str(tmp_path), "late").collect()}
    late = {seq for seq, is_late in late_by_definition(rows).items() if is_late}
    assert got == late and late
    want = stream_features(frame(spark, [r for r in rows if r[0] not in late])).orderBy("user_id", "window_start")
    got = jobs.job_output(spark, str(tmp_path), "features").select(*want.columns)
    assert [(*r[:4], round(r[4], 6)) for r in got.orderBy("user_id", "window_start").collect()] == [
        (*r[:4], round(r[4], 6)) for r in want.collect()]
    want = replay.burst_windows(frame(spark, rows), 2)
    got = jobs.job_output(spark, str(tmp_path), "bursts", 2).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_arrivals_out_of_order_are_counted(spark, tmp_path):
    step = jobs.job_batch(spark, str(tmp_path))
    for batch, second in enumerate((1, 100, 2)):
        step(marked(spark, [(batch, f"t{batch}", "u", 1.0, START, START + second * SEC)]), batch)
    got = {(r.event_count, r.burst_detected) for r in jobs.job_output(spark, str(tmp_path), "bursts", 2).collect()}
    assert got == {(2, True), (1, False)}


def test_identical_resends_have_one_first(spark):
    rows = [(0, "a", "u", 1.0, START, START)] * 3 + [(1, "b", "u", 1.0, START, None)] * 2
    for df in (frame(spark, rows), frame(spark, rows).drop("seq")):
        got = sorted((r.transaction_id, r.is_duplicate) for r in replay.mark_repeats(df).collect())
        assert got == [("a", False), ("a", True), ("a", True), ("b", False), ("b", True)]


def test_the_live_job_sets_bad_messages_aside_and_bears_missing_clocks(spark, tmp_path):
    rows = [(i, f"t{i}", "u", 1.0, START, START) for i in range(4)]
    source = feed(spark, tmp_path, [rows[:2], rows[2:]])
    good = ('{"transaction_id":"x","user_id":"u","amount":1,"timestamp":"2024-01-01T00:00:00"}\n' * 2)
    (tmp_path / "in" / "002.json").write_text(good + "broken\n")
    jobs.run_job(stream_in.file_lines(spark, source, files_per_batch=1), f"{tmp_path}/out", bounded=True,
                 text_lines=True)
    out = {n: jobs.job_output(spark, f"{tmp_path}/out", n) for n in ("marked", "features", "quarantine")}
    assert [r.value for r in out["quarantine"].collect()] == ["broken"]
    assert out["marked"].filter("is_duplicate").count() == 1
    assert [r["count"] for r in out["features"].collect()] == [5]
    text = spark.read.option("recursiveFileLookup", "true").text(f"{tmp_path}/out/text/DUPLICATE").collect()
    assert len(text) == 1 and text[0].value.startswith("DUPLICATE | transaction_id=x")


def test_bursts_count_raw_arrivals(spark):
    rows = [(i, "same", "u", 1.0, START, START + i * SEC) for i in range(12)]
    got = [(r.event_count, r.burst_detected) for r in
           replay.burst_windows(frame(spark, rows), threshold=10).orderBy("window_start").collect()]
    assert got == [(10, True), (2, False)]


# --- Live -------------------------------------------------------------------------------------


def lines(spark, rows):
    return frame(spark, rows).select(stream_in.json_line(
        "transaction_id", "user_id", "amount", F.col("event_time").alias("timestamp"),
        "ingested_at", "seq").alias("value"))


def feed(spark, tmp_path, batches):
    """JSON folders whose files come in the order of `batches`."""
    folder = tmp_path / "in"
    folder.mkdir(parents=True)
    for i, rows in enumerate(batches):
        text = "\n".join(r.value for r in lines(spark, rows).collect())
        path = folder / f"{i:03d}.json"
        path.write_text(text)
        import os
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return str(folder)


def test_parsing_sets_bad_records_aside(spark):
    good = '{"transaction_id":"t","user_id":"u","amount":"2.5","timestamp":"2024-01-01T00:00:00"}'
    bad = ['{"user_id":"u","amount":1,"timestamp":"2024-01-01T00:00:00"}',
           '{"transaction_id":"t","user_id":"u","amount":"x","timestamp":"2024-01-01T00:00:00"}',
           '{"transaction_id":"t","user_id":"u","amount":1,"timestamp":"soon"}', "not json"]
    df = spark.createDataFrame([(v,) for v in [good, *bad]], "value string")
    row, = stream_in.valid_events(df).collect()
    assert (row.amount, row.event_time) == (2.5, START)
    assert sorted(r.value for r in stream_in.quarantined(df).collect()) == sorted(bad)


def test_live_dedup_over_several_batches(spark, tmp_path):
    rows = [(i, f"t{i % 20}", "u", 1.0, START + i * SEC, START + i * SEC) for i in range(60)]
    source = feed(spark, tmp_path, [rows[:25], rows[25:40], rows[40:]])
    events = stream_in.valid_events(stream_in.file_lines(spark, source, files_per_batch=1))
    jobs.run_marking(events, f"{tmp_path}/out", f"{tmp_path}/cp", bounded=True).awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len(out) == 60
    assert {r.seq for r in out if not r.is_duplicate} == set(range(20))


def test_live_ttl_expires_in_processing_time(spark, tmp_path):
    import time
    row = (0, "t", "u", 1.0, START, START)
    source = feed(spark, tmp_path, [[row]])
    events = stream_in.valid_events(stream_in.file_lines(spark, source))

    def again():
        jobs.run_marking(events, f"{tmp_path}/out", f"{tmp_path}/cp", bounded=True,
                         ttl_ms=3000).awaitTermination()

    again()
    time.sleep(4)
    text = (tmp_path / "in" / "000.json").read_text()
    (tmp_path / "in" / "001.json").write_text(text)
    again()
    assert [r.is_duplicate for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [
        False, False]


def test_live_windows_equal_the_batch_form(spark, tmp_path):
    rows = [r for r in random_stream(8, n=120, ids=10**6, jitter_minutes=0)]
    batches = [rows[i:i + 30] for i in range(0, 120, 30)]
    source = feed(spark, tmp_path, batches)
    events = stream_in.valid_events(stream_in.file_lines(spark, source, files_per_batch=1))
    jobs.to_table(jobs.window_features(events), f"{tmp_path}/out", f"{tmp_path}/cp",
                  bounded=True).awaitTermination()
    final = max(r[4] for r in rows) - 70 * SEC
    want = stream_features(frame(spark, rows)).filter(F.col("window_end") <= F.lit(final))
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == sorted(
        map(tuple, want.collect()))


def test_refinements_end_in_the_batch_form(spark, tmp_path):
    rows = random_stream(9, n=120, ids=10**6, jitter_minutes=0)
    source = feed(spark, tmp_path, [rows[i:i + 30] for i in range(0, 120, 30)])
    events = stream_in.valid_events(stream_in.file_lines(spark, source, files_per_batch=1))
    jobs.run_refining(events, f"{tmp_path}/out", f"{tmp_path}/cp", bounded=True).awaitTermination()
    got = jobs.refined_features(spark, f"{tmp_path}/out")
    want = stream_features(frame(spark, rows))
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(
        map(tuple, want.collect()))


def test_bursts_of_raw_messages_by_file_arrival(spark, tmp_path):
    source = feed(spark, tmp_path, [[(i, "t", "u", 1.0, START, START)] * 3 for i in range(4)])
    lines = stream_in.file_lines(spark, source, files_per_batch=1)
    jobs.to_table(jobs.burst_monitor(lines, 3), f"{tmp_path}/out", f"{tmp_path}/cp",
                  bounded=True).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(r.event_count, r.burst_detected) for r in got] == [(3, True), (3, True)]


@pytest.mark.parametrize("top, count", [(370 * SEC, 1), (370 * SEC - MIN / 60000, 2)])
def test_live_drop_boundary(spark, tmp_path, top, count):
    def row(seq, when):
        return [(seq, f"t{seq}", "u", 1.0, START + when, START + seq * SEC)]
    # One batch lies between the advance and the late row, and the last one closes every window.
    source = feed(spark, tmp_path, [row(0, MIN), row(1, top), row(2, top), row(3, MIN),
                                    row(4, 60 * MIN)])
    events = stream_in.valid_events(stream_in.file_lines(spark, source, files_per_batch=1))
    jobs.to_table(jobs.window_features(events), f"{tmp_path}/out", f"{tmp_path}/cp",
                  bounded=True).awaitTermination()
    first = spark.read.parquet(f"{tmp_path}/out").filter(F.col("window_start") == F.lit(START))
    assert [r["count"] for r in first.collect()] == [count]


def test_tagged_lines(spark):
    df = spark.createDataFrame([("t1", "u1", 2.0, "2024-01-01T00:00:00")],
                               "transaction_id string, user_id string, amount double,"
                               " timestamp string")
    row = jobs.tagged_lines(df, "LATE").first()
    assert tuple(row) == ("LATE", "LATE | transaction_id=t1 | user_id=u1 | amount=2.00 |"
                                  " event_time=2024-01-01T00:00:00")


def test_seen_keys_by_time_and_batches_run_again(spark, tmp_path):
    from ledgerlake.streaming.dedup import CLOCK, Seen
    seen = Seen(spark, str(tmp_path), ttl_ms=10_000)

    def step(batch_id, second, *ids):
        rows = [(key, i, START + second * SEC) for i, key in enumerate(ids)]
        batch = spark.createDataFrame(rows, f"transaction_id string, position long, {CLOCK} timestamp")
        out = seen.flagged(batch, batch_id).collect()
        seen.remember(batch, spark.createDataFrame(out, "transaction_id string, position long, is_duplicate boolean"),
                      batch_id)
        return [r.transaction_id for r in sorted(out, key=lambda r: r.position) if not r.is_duplicate]

    assert step(0, 0, "a", "a", None, None) == ["a", None]
    assert step(1, 4, "a", "b") == ["b"]
    assert step(1, 4, "a", "b") == ["b"]  # run again
    assert step(2, 9, None, "b", "c") == ["c"]
    assert step(3, 10, "a", "b", "a") == ["a"]  # new again after ten seconds, though it came at four
    assert step(4, 14, "a", "b") == ["b"]
    assert step(5, 14) == []


def test_the_live_job_sends_no_row_through_python(spark, tmp_path):
    rows = [(i, f"t{i % 20}", "u", 1.0, START + i * SEC, START + i * SEC) for i in range(60)]
    source = feed(spark, tmp_path, [rows[:25], rows[25:]])
    queries = jobs.run_job(stream_in.file_lines(spark, source, files_per_batch=1), f"{tmp_path}/out", bounded=True)
    assert not queries["events"].lastProgress["stateOperators"]
    marked = jobs.job_output(spark, f"{tmp_path}/out", "marked")
    assert {r.seq for r in marked.filter("NOT is_duplicate").collect()} == set(range(20))
