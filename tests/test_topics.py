import datetime as dt
import json

from ledgerlake.__main__ import arguments, run
from ledgerlake.sources.folders import qualified
from ledgerlake.streaming import jobs
from ledgerlake.streaming.events import topic_report
from ledgerlake.streaming.topics import Topic, export_topic, topic_lines

AT = dt.datetime(2024, 1, 1)


def messages(spark, first, last, partitions=("0", "1")):
    rows = [(p, i, AT + dt.timedelta(seconds=i), json.dumps(
        {"transaction_id": f"t{p}-{i}", "user_id": "u", "amount": 1.0, "timestamp": "2024-01-01T00:00:00"})
        if i % 5 else "broken") for p in partitions for i in range(first, last)]
    return spark.createDataFrame(rows, "partition string, offset long, arrived_at timestamp, value string")


def at(rows):
    return sorted((r.partition, r.position) for r in rows)


def test_bounded_reads_take_the_offsets_asked_for(spark, tmp_path):
    path = str(tmp_path / "topic")
    assert topic_lines(spark, path).collect() == []
    export_topic(messages(spark, 0, 10), path)
    export_topic(messages(spark, 10, 20, ("1", "2")), path)
    everything = topic_lines(spark, path).collect()
    assert at(everything) == sorted([("0", i) for i in range(10)] + [("1", i) for i in range(20)]
                                    + [("2", i) for i in range(10, 20)])
    assert {r.arrived_at - AT for r in everything if r.position == 3} == {dt.timedelta(seconds=3)}
    some = topic_lines(spark, path, '{"0": 8, "1": 15}', '{"1": 17, "2": 12}').collect()
    assert at(some) == [("0", 8), ("0", 9), ("1", 15), ("1", 16), ("2", 10), ("2", 11)]
    assert topic_lines(spark, path, "latest").collect() == []


def test_only_the_segments_needed_are_opened(spark, tmp_path):
    path = str(tmp_path / "topic")
    for i in range(4):
        export_topic(messages(spark, i * 10, i * 10 + 10, ("0",)), path)
    topic = Topic(qualified(spark, path))
    assert [(s.start, s.end) for s in topic.stretches({"0": 15}, {"0": 21})] in ([(15, 20), (20, 21)], [(20, 21), (15, 20)])
    assert topic.earliest() == {"0": 0} and topic.latest() == {"0": 40}


def test_a_stopped_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / x) for x in ("topic", "out", "checkpoint"))
    export_topic(messages(spark, 0, 10), path)
    seen = []
    for first, last, partitions in ((10, 12, ("0",)), (10, 13, ("1", "2")), (0, 0, ())):
        jobs.to_table(topic_lines(spark, path, "earliest", streaming=True), out, checkpoint, True).awaitTermination()
        seen.append(spark.read.parquet(out).count())
        if partitions:
            export_topic(messages(spark, first, last, partitions), path)
    assert seen == [20, 22, 28]
    assert at(spark.read.parquet(out).collect()) == at(topic_lines(spark, path).collect())


def test_counts_of_a_topic_and_the_command(spark, tmp_path, capsys):
    path = str(tmp_path / "topic")
    export_topic(messages(spark, 0, 10), path)
    got = {r.partition: tuple(r)[1:] for r in topic_report(topic_lines(spark, path)).collect()}
    assert got == {p: (10, 2, 8, 0, 9) for p in "01"}
    args = arguments().parse_args(["--root", str(tmp_path), "topic", "--segments", path])
    assert run(args, spark) == 0
    assert "last_position" in capsys.readouterr().out
