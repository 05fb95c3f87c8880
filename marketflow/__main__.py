"""Command line: `python -m marketflow batch|feed|land|live ...`."""

from __future__ import annotations

import argparse

from marketflow.plans.batch import run_batch
from marketflow.plans.landing import feed_deliveries, land_deliveries
from marketflow.plans.live import run_live, seed
from marketflow.session import build_session
from marketflow.sources.files import read_landed_bars, read_sector_tree
from marketflow.streaming.sources import broker_options, follow_sector_tree, open_records
from marketflow.streaming.tail import tail_sector_tree


def main() -> None:
    parser = argparse.ArgumentParser(prog="marketflow")
    jobs = parser.add_subparsers(dest="job", required=True)

    land = jobs.add_parser("land", help="land delivered bar files by sector and ticker")
    land.add_argument("--deliveries", required=True)
    land.add_argument("--bars", required=True)
    land.add_argument("--rejects", help="where bars without a sector go; by default beside the bars")

    feed = jobs.add_parser("feed", help="publish delivered bar files as a cycle that the live job follows")
    feed.add_argument("--deliveries", required=True)
    feed.add_argument("--feed", required=True)
    feed.add_argument("--cycle", required=True, help="name of the cycle; one that is out is not published again")

    batch = jobs.add_parser("batch", help="fit, forecast and publish all sectors")
    batch.add_argument("--bars", required=True)
    batch.add_argument("--models", required=True)
    batch.add_argument("--results", required=True)
    batch.add_argument("--window-size", type=int, default=10)
    batch.add_argument("--horizon", type=int)

    live = jobs.add_parser("live", help="follow records and keep the store current")
    source = live.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="broker addresses")
    source.add_argument("--files", help="folder of {sector}/*.txt whose files are put in place whole, such as a feed")
    source.add_argument("--tail", help="folder of {sector}/*.txt whose files grow or are rewritten")
    live.add_argument("--results", help="batch results to seed the store with")
    live.add_argument("--store", required=True)
    live.add_argument("--checkpoint", required=True)
    live.add_argument("--dead-letters")
    live.add_argument("--every", default="15 minutes")
    live.add_argument("--delay", default="2 days")
    live.add_argument("--seconds", type=float, help="stop after this long")

    args = parser.parse_args()
    spark = build_session()
    if args.job == "land":
        land_deliveries(read_sector_tree(spark, args.deliveries), args.bars, args.rejects)
    elif args.job == "feed":
        feed_deliveries(read_sector_tree(spark, args.deliveries), args.feed, args.cycle)
    elif args.job == "batch":
        run_batch(
            read_landed_bars(spark, args.bars), args.results, args.models, args.window_size, args.horizon
        )
    else:
        if args.results:
            seed(spark, args.results, args.store)
        records = (
            open_records(spark, "kafka", **broker_options(args.servers))
            if args.servers
            else tail_sector_tree(spark, args.tail)
            if args.tail
            else follow_sector_tree(spark, args.files)
        )
        spark.streams.resetTerminated()
        queries = run_live(
            records, args.store, args.checkpoint, args.every, args.delay, dead_letters=args.dead_letters
        )
        try:
            # ends with the first query that ends or fails
            spark.streams.awaitAnyTermination(args.seconds)
        finally:
            for query in queries:
                query.stop()


if __name__ == "__main__":
    main()
