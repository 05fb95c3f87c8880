"""The live job: seed the store with the batch results, then follow the records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marketflow.operators.records import parse_records, split_malformed
from marketflow.operators.series import overlay
from marketflow.sinks.results import compact, next_version, upsert
from marketflow.sources.files import read_results
from marketflow.streaming.live import (
    append_files,
    bounded_sector_means,
    correct_stream,
    flatten,
    sector_means,
    upsert_stream,
)


def seed(spark: SparkSession, result_path: str, store: str) -> None:
    """Put history and forecast into the store; seeding again replaces them.

    Each seed folds what the store has gathered since the one before.
    """
    upsert(overlay(read_results(spark, result_path)), store, next_version(spark, store))
    compact(spark, store)


def run_live(
    records: DataFrame,
    store: str,
    checkpoint: str,
    every: str | None = "15 minutes",
    delay: str | None = "2 days",
    dedup: bool = True,
    dead_letters: str | None = None,
    ahead: str = "1 year",
) -> list[StreamingQuery]:
    """Start the live means of all sectors; one query serves every topic.

    With a delay, state is bounded by the watermark and every mean is out at once. The
    last delivery of a bar counts, once, and corrects the means that are out; with
    `dedup` off every delivery counts. Records that do not parse, and those dated
    further ahead than `ahead` from the start of the job, are appended to `dead_letters` by a second
    query; bars later than the delay are counted by the first (`live.losses`). Without
    a delay, every timestamp is kept, every delivery counts, and what does not parse
    forms the null timestamp.
    """
    if delay is None:
        means = sector_means(flatten(parse_records(records)))
        return [upsert_stream(means, store, f"{checkpoint}/means", every)]
    latest = records.sparkSession.sql(f"SELECT unix_millis(current_timestamp() + INTERVAL {ahead})").first()[0]
    good, bad = split_malformed(records, latest_ms=latest)
    bars = flatten(good)
    first = (
        correct_stream(bars, store, f"{checkpoint}/means", every, delay)
        if dedup
        else upsert_stream(bounded_sector_means(bars, delay), store, f"{checkpoint}/means", every)
    )
    return [first, append_files(bad, dead_letters or f"{store}-dead", f"{checkpoint}/dead", ("topic",), every)]
