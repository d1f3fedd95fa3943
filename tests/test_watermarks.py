import datetime as dt
import random

import pytest

from ledgerlake.sources.folders import names
from ledgerlake.streaming.watermarks import late_batch, mark_late_by_source

EVENTS = "partition string, ingested_at timestamp, seq long, event_time timestamp"
START = dt.datetime(2024, 1, 1)


def moment(seconds):
    return None if seconds is None else START + dt.timedelta(seconds=seconds)


def brute(rows, idle=30, delay=70, width=300):
    """Walks through all rows in order of arrival; also lets partitions fall idle in between."""
    newest, last, mark, out = {}, {}, float("-inf"), {}
    for source, at, seq, event in sorted(rows, key=lambda r: (r[1], r[2])):
        for due in sorted(t + idle for t in last.values() if t + idle < at):
            live = [s for s in last if last[s] + idle > due]
            if live:
                mark = max(mark, min(newest[s] for s in live))
        out[seq] = mark >= (event // width + 1) * width + delay
        newest[source] = max(newest.get(source, float("-inf")), event)
        last[source] = at
        live = [s for s in last if last[s] + idle >= at]
        mark = max(mark, min(newest[s] for s in live))
    return out


def made(seed, n=400):
    rng, rows, at = random.Random(seed), [], 0
    for seq in range(n):
        at += rng.choice([0, 1, 4, 9, 40])
        source = rng.choice(["a", "a", "b", "c" if at < 900 else "a", None])
        event = at - rng.choice([0, 0, 5, 200, 900]) - (400 if source == "b" else 0)
        rows.append((source, at, seq, event))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(s, moment(a), q, moment(e)) for s, a, q, e in rows], EVENTS).repartition(3)


@pytest.mark.parametrize("seed", range(3))
def test_as_row_by_row(spark, seed):
    rows = made(seed)
    marked, state = mark_late_by_source(frame(spark, rows))
    assert {r.seq: r.is_late for r in marked.collect()} == brute(rows)
    assert any(brute(rows).values()) and not all(brute(rows).values())
    assert {r.source for r in state.collect()} == {None, "", "a", "b", "c"}


@pytest.mark.parametrize("cuts", [[100], [1, 7, 200, 390]])
def test_batches_carry_their_state_and_can_run_again(spark, tmp_path, cuts):
    rows = made(7)
    step = late_batch(spark, str(tmp_path))
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        step(frame(spark, rows[a:b]), i)
        if i == 1:
            step(frame(spark, rows[a:b]), i)
    got = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/marked").collect()
    assert len(got) == len(rows) and {r.seq: r.is_late for r in got} == brute(rows)
    assert len(names(spark, f"{tmp_path}/state")) == len(cuts) + 1


def test_a_slow_source_holds_windows_open_until_it_is_silent(spark):
    base = [("slow", 0, 0, 0), ("fast", 1, 1, 1000), ("slow", 20, 2, 10), ("fast", 40, 3, 1010),
            ("slow", 45, 4, 20), ("fast", 70, 5, 1020), ("fast", 80, 6, 30)]
    marked, _ = mark_late_by_source(frame(spark, base))
    assert {r.seq: r.is_late for r in marked.collect()} == {i: i == 6 for i in range(7)}


def test_no_rows_and_rows_without_clocks(spark):
    marked, state = mark_late_by_source(frame(spark, []))
    assert marked.collect() == [] and state.collect() == []
    marked, _ = mark_late_by_source(frame(spark, [("a", None, 1, 5), ("a", 3, 2, None), ("a", 4, 3, 900)]))
    assert [r.is_late for r in marked.collect()] == [False] * 3
