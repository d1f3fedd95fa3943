"""Command line: `python -m ledgerlake <job> --root <lake root>` (or through spark-submit)."""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession

from ledgerlake import config
from ledgerlake.operators.profile import skew_profile
from ledgerlake.plans import gold, measure, silver, validate
from ledgerlake.sources.layout import layout_report
from ledgerlake.sources.supplied import wallet
from ledgerlake.sources.tables import ingest, read_table
from ledgerlake.streaming import events, jobs
from ledgerlake.streaming.topics import topic_lines


def arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerlake", description=__doc__)
    top.add_argument("--root", required=True, help="lake root with bronze/, silver/, gold/")
    top.add_argument("--format", default="parquet", help="table format (parquet, delta, ...)")
    top.add_argument("--mode", choices=measure.MODES, default="optimized", help="AQE off or on")
    job = top.add_subparsers(dest="job", required=True)

    bronze = job.add_parser("bronze", help="load source Parquet into Bronze")
    bronze.add_argument("--source", required=True, help="folder of <table>.parquet")
    bronze.add_argument("--supplied", action="store_true", help="map TPC-H-like tables on the fly")
    bronze.add_argument("--tables", nargs="+")
    bronze.add_argument("--write-mode", choices=("overwrite", "append"), default="overwrite")
    bronze.add_argument("--continue-on-error", action="store_true")
    bronze.add_argument("--database", help="also register the tables here")

    job.add_parser("silver", help="Bronze to Silver")
    job.add_parser("gold", help="Silver to Gold")
    job.add_parser("validate-silver")
    job.add_parser("validate-gold")
    job.add_parser("layout", help="file layout of the large tables")
    job.add_parser("skew", help="merchant skew profile and timed workload")
    distinct = job.add_parser("distinct", help="exact against approximate distinct count")
    distinct.add_argument("--rsd", type=float, default=config.DEFAULT_RSD)

    topic = job.add_parser("topic", help="read a topic from its first to its last message and count")
    topic.add_argument("--servers", help="Kafka bootstrap servers")
    topic.add_argument("--topic", default="transactions.raw")
    topic.add_argument("--segments", help="folder of exported segments, in place of Kafka")
    topic.add_argument("--starting", default="earliest", help="earliest, latest or offsets as JSON")

    for name in ("stream", "burst"):
        live = job.add_parser(name)
        live.add_argument("--segments", help="folder of exported topic segments, in place of Kafka")
        live.add_argument("--servers", help="Kafka bootstrap servers")
        live.add_argument("--topic", default="transactions.raw")
        live.add_argument("--lines", help="folder of JSON lines, in place of Kafka")
        live.add_argument("--threshold", type=int, default=config.BURST_THRESHOLD)
        live.add_argument("--bounded", action="store_true", help="stop at the end of the input")
    return top


def live_lines(spark: SparkSession, args):
    if args.lines:
        return events.file_lines(spark, args.lines)
    if args.segments:
        return topic_lines(spark, args.segments, "earliest", streaming=True)
    return events.kafka_lines(spark, args.servers, args.topic)


def run(args, spark: SparkSession) -> int:
    lake = config.Lakehouse(args.root, args.format)
    if args.job == "bronze":
        def source(table: str):
            if args.supplied:
                return wallet(spark, args.source, table)
            return spark.read.parquet(f"{args.source}/{table}.parquet")
        summary = ingest(spark, lake, source, args.tables, args.write_mode,
                         args.continue_on_error, args.database)
        summary.show(truncate=False)
        return 1 if summary.filter("error IS NOT NULL").count() else 0
    if args.job == "silver":
        silver.run_silver(spark, lake).show(truncate=False)
    elif args.job == "gold":
        gold.run_gold(spark, lake)
    elif args.job == "validate-silver":
        validate.validate_silver(spark, lake)
    elif args.job == "validate-gold":
        validate.validate_gold(spark, lake)
    elif args.job == "layout":
        for zone, table in (("silver", "transactions"), ("gold", "fact_transactions"),
                            ("gold", "obt_transaction_enriched")):
            layout_report(read_table(spark, lake, zone, table), f"{zone}.{table}", ("event_date",)).show()
    elif args.job in ("skew", "distinct"):
        transactions = read_table(spark, lake, "silver", "transactions")
        if args.job == "skew":
            skew_profile(transactions, "merchant_id").show(vertical=True)
            merchants = read_table(spark, lake, "silver", "merchants")
            print(json.dumps(measure.merchant_benchmark(
                spark, transactions, merchants, args.mode, explain=True)))
        else:
            print(json.dumps(measure.distinct_benchmark(spark, transactions, rsd=args.rsd)))
    elif args.job == "topic":
        lines = (topic_lines(spark, args.segments, args.starting) if args.segments else
                 events.kafka_lines(spark, args.servers, args.topic, args.starting, streaming=False))
        events.topic_report(lines).show(truncate=False)
    elif args.job == "stream":
        for query in jobs.run_job(live_lines(spark, args),
                                  f"{args.root}/stream", args.bounded, args.threshold,
                                  text_lines=True).values():
            query.awaitTermination()
    elif args.job == "burst":
        # Every raw message counts, by its arrival.
        jobs.to_table(jobs.burst_monitor(live_lines(spark, args), args.threshold),
                      f"{args.root}/stream/burst_monitor", f"{args.root}/stream/_checkpoints/burst",
                      args.bounded).awaitTermination()
    return 0


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s | %(levelname)-8s | %(message)s")
    args = arguments().parse_args(argv)
    spark = (SparkSession.builder.appName(f"ledgerlake-{args.job}")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    with measure.adaptive(spark, args.mode):
        return run(args, spark)


if __name__ == "__main__":
    raise SystemExit(main())
