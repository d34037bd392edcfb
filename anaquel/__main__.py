"""Command line for spark-submit; the master and cluster settings come from the submitter.

    python -m anaquel cycle --bronze DIR --out DIR
    python -m anaquel seasonality --bronze DIR
    python -m anaquel accept --bronze DIR
    python -m anaquel impact --bronze DIR --out DIR
    python -m anaquel ingest --servers HOST:PORT --out DIR --checkpoint DIR
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from anaquel.plans import pipeline
from anaquel.session import clear_scratch, configure
from anaquel.sources import readers, snapshots, writers
from anaquel.streaming import ingest


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="anaquel")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("cycle", "seasonality", "accept", "impact"):
        command = commands.add_parser(name)
        command.add_argument("--bronze", required=True)
        if name in ("cycle", "impact"):
            command.add_argument("--out", required=True)
            command.add_argument("--stream-format", choices=("parquet", "csv"), default="parquet")
        if name == "cycle":
            command.add_argument("--keep", type=int, default=3, metavar="N", help="versions to keep for readers")
    stream = commands.add_parser("ingest")
    stream.add_argument("--servers", required=True)
    stream.add_argument("--topic", default="ventas")
    stream.add_argument("--out", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--seconds", type=int, default=60)
    stream.add_argument("--dedupe", metavar="DELAY", help="drop deliveries repeated within e.g. '10 minutes'")
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName("anaquel").getOrCreate())
    if args.command == "cycle":
        inputs = pipeline.read_bronze(spark, args.bronze, args.stream_format)
        pipeline.run_cycle(spark, inputs, args.out)
        snapshots.expire(spark, args.out, args.keep)
    elif args.command == "seasonality":
        pipeline.refresh_seasonality(spark, args.bronze)
    elif args.command == "accept":
        series = readers.read_index_series(spark, f"{args.bronze}/ine.json")
        pipeline.accept_inputs(pipeline.read_bronze(spark, args.bronze), series, args.bronze)
    elif args.command == "impact":
        inputs = pipeline.read_bronze(spark, args.bronze, args.stream_format)
        for name, report in pipeline.impact_report(inputs).items():
            writers.save(report, f"{args.out}/{name}")
        clear_scratch(spark)
    else:
        sales = ingest.parse_sales(ingest.kafka_messages(spark, args.servers, args.topic))
        if args.dedupe:
            sales = ingest.dedupe_deliveries(sales, args.dedupe)
        ingest.land(sales, args.out, args.checkpoint, args.seconds).awaitTermination()


if __name__ == "__main__":
    main()
