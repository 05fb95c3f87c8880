"""The landing job: from ticks or delivered bar files to landed bars and topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marketflow.operators.bars import dedup_bars, request_bars
from marketflow.operators.series import assign_sectors
from marketflow.schema import DAILY_FEED, ticker_dimension
from marketflow.sinks.feed import publish_cycle
from marketflow.sinks.files import land_bars
from marketflow.streaming.live import broker_sink
from marketflow.streaming.sources import follow_sector_tree


def land_request(
    ticks: DataFrame, path: str, end_ms: int, feed: tuple[int, str, str] = DAILY_FEED
) -> None:
    """Answer one feed's request for every ticker at once and land the bars.

    The end of the look-back is evaluated per run, so the range moves with it.
    """
    multiplier, unit, interval = feed
    wanted = request_bars(ticks, multiplier, unit, end_ms, interval)
    land_bars(wanted, ticker_dimension(ticks.sparkSession), path)


def land_deliveries(bars: DataFrame, path: str, rejects: str | None = None) -> None:
    """Land delivered bars, one row per ticker and time however often delivered.

    Bars read by sector folder keep that sector; what has none goes to `rejects`.
    """
    unique = dedup_bars(bars, prefer=("numberOfItems",))
    land_bars(unique, ticker_dimension(bars.sparkSession), path, rejects)


def feed_deliveries(bars: DataFrame, feed: str, cycle: str) -> bool:
    """Publish delivered bars as one cycle of a feed that the live job follows."""
    unique = dedup_bars(bars, prefer=("numberOfItems",))
    known, unknown = assign_sectors(unique, ticker_dimension(bars.sparkSession))
    published = publish_cycle(known, feed, cycle)
    if published:
        unknown.write.mode("overwrite").json(f"{feed.rstrip('/')}/_rejects/{cycle}")
    return published


def publish_files(
    spark: SparkSession, root: str, servers: str, checkpoint: str, every: str | None = "1 second"
) -> StreamingQuery:
    """Send the lines of `{root}/{sector}/{ticker}.txt` to the topic of their sector."""
    return broker_sink(follow_sector_tree(spark, root).select("value", "topic"), servers, checkpoint, every)
