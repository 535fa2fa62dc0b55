"""Commands for spark-submit: ingest, refresh, replay, land.

    spark-submit filingmill/jobs.py refresh --root s3a://bucket/lake --warehouse s3a://bucket/curated
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from filingmill.plans.refresh import Lake, refresh, refresh_dates
from filingmill.schemas import TOPIC
from filingmill.session import build_session
from filingmill.sources.landing import dataset_path, ingest_pages, missing_periods
from filingmill.sources.messages import (
    partitions_between,
    quarantine_keyless_partitions,
    replay_partitions,
    send_to_kafka,
)
from filingmill.sources.warehouse import Warehouse
from filingmill.streaming.counts import LandingListener
from filingmill.streaming.landing import (
    FILE_MESSAGES,
    FLUSH_MESSAGES,
    STREAM_DATASET,
    kafka_messages,
    start_landing,
)

logger = logging.getLogger(__name__)


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="land fetched pages in a raw dataset")
    ingest.add_argument("--pages", required=True)
    ingest.add_argument("--dataset", required=True)
    ingest.add_argument("--partition", required=True, help="record field that names the partition")
    ingest.add_argument("--source-url", required=True)

    build = commands.add_parser("refresh", help="raw layer to published tables")
    build.add_argument("--warehouse", required=True, help="folder of the curated tables")
    build.add_argument("--database", default="curated")
    build.add_argument("--buckets", type=int, help="of the fact table; by its rows by default")
    build.add_argument("--first", help="first report date, yyyyMMdd, to clean again; all by default")
    build.add_argument("--last", help="last report date to clean again")

    replay = commands.add_parser("replay", help="send raw partitions to the topic")
    replay.add_argument("--first", default="", help="first report date, yyyyMMdd; all by default")
    replay.add_argument("--last", default="9" * 8, help="last report date")
    replay.add_argument("--limit", type=int, help="filings of each date, the first by key and batch")

    land = commands.add_parser("land", help="land the topic in the raw layer")
    land.add_argument("--checkpoint", required=True)
    land.add_argument("--flush-messages", type=int, default=FLUSH_MESSAGES, help="new messages that start a batch")
    land.add_argument("--most-messages", type=int, help="of one batch; all there are by default")
    land.add_argument("--tasks", type=int, help="that write a batch; the session's shuffle partitions by default")
    land.add_argument("--file-messages", type=int, default=FILE_MESSAGES, help="of one file")
    land.add_argument("--forever", action="store_true", help="poll instead of draining and stopping")

    for command in (ingest, build, replay, land):
        command.add_argument("--root", required=True, help="folder of the lake")
    for command in (replay, land):
        command.add_argument("--servers", required=True)
        command.add_argument("--topic", default=TOPIC)
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = _arguments(argv)
    spark = build_session(f"filingmill-{args.command}")
    if args.command == "ingest":
        short = ingest_pages(
            spark, args.pages, args.root, args.dataset, args.partition, source_url=args.source_url
        )
        for row in short:
            logger.warning("incomplete: %s", row.asDict())
    elif args.command == "refresh":
        warehouse = Warehouse(spark, args.database, args.warehouse, args.buckets)
        lake = Lake(spark, args.root, warehouse)
        if args.first and args.last:
            for dataset, value in missing_periods(spark, args.root, args.first, args.last):
                logger.warning("not landed: %s of %s", dataset, value)
        if args.first or args.last:
            counts = refresh_dates(lake, args.first or "0", args.last or "9" * 8)
        else:
            counts = refresh(lake)
        logger.info("rows: %s", counts)
    elif args.command == "replay":
        path = dataset_path(args.root, "financials")
        if not partitions_between(spark, path, args.first, args.last):
            raise SystemExit(f"no raw filings from {args.first} to {args.last}")
        sent = replay_partitions(spark, path, args.first, args.last, args.limit)
        send_to_kafka(sent, args.servers, args.topic)
        count = quarantine_keyless_partitions(spark, path, args.root, args.first, args.last)
        logger.info("filings without a key: %s", count)
    else:
        stream = kafka_messages(spark, args.servers, args.topic, args.flush_messages, args.most_messages)
        totals: dict[str, int] = {}
        spark.streams.addListener(LandingListener(spark, args.root, STREAM_DATASET))
        query = start_landing(
            stream,
            args.root,
            args.checkpoint,
            topic=args.topic,
            run_forever=args.forever,
            tasks=args.tasks,
            file_messages=args.file_messages,
            totals=totals,
        )
        query.awaitTermination()
        logger.info("messages: %s", totals)


if __name__ == "__main__":
    main()
