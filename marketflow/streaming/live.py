"""Live sector means, their sink, and the other streaming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from marketflow.functions import format_date, format_instant, mean_2dp
from marketflow.operators.records import word_count
from marketflow.operators.series import overlay
from marketflow.sinks import keyed
from marketflow.sinks import results
from marketflow.sinks.results import STREAM, next_version, upsert

BAR_MS = 15 * 60_000
#: micro-batches after which a store is compacted
COMPACT_EVERY = 20

#: the last delivery of every bar; bars of one day share a bucket
LIVE_BARS = keyed.Layout(
    StructType(
        [
            StructField("sector", StringType()),
            StructField("tickerSymbol", StringType()),
            StructField("timestamp", LongType()),
            StructField("close", DoubleType()),
        ]
    ),
    ("sector", "tickerSymbol", "timestamp"),
    lambda: F.coalesce(format_date(F.col("timestamp")), F.lit("none")),
)


def flatten(parsed: DataFrame) -> DataFrame:
    """`close`, `timestamp`, `tickerSymbol` and the sector out of parsed records, and `delivery` if they have it."""
    return parsed.select(
        F.col("data.close"),
        F.col("data.timestamp"),
        F.col("data.tickerSymbol"),
        F.col("topic").alias("sector"),
        *[c for c in parsed.columns if c == "delivery"],
    )


def dedup_stream(bars: DataFrame, delay: str = "2 days") -> DataFrame:
    """Drop repeated deliveries of a bar; keys older than the delay are forgotten."""
    timed = bars.withColumn("event_time", F.timestamp_millis("timestamp"))
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(
        ["tickerSymbol", "timestamp"]
    )


def sector_means(bars: DataFrame) -> DataFrame:
    """Mean close per sector and timestamp, for ever: every timestamp stays in state."""
    return bars.groupBy("sector", "timestamp").agg(mean_2dp(F.col("close")).alias("avg_close"))


def bounded_sector_means(bars: DataFrame, delay: str = "2 days", bar_ms: int = BAR_MS) -> DataFrame:
    """The same means with a watermark: bars later than the delay are left out.

    One query serves all sectors. Means are combined before the shuffle, so a
    busy sector costs one state row per bar interval.
    """
    timed = bars if "event_time" in bars.columns else bars.withColumn(
        "event_time", F.timestamp_millis("timestamp")
    ).withWatermark("event_time", delay)
    grouped = timed.groupBy("sector", F.window("event_time", f"{bar_ms // 1000} seconds"))
    return grouped.agg(mean_2dp(F.col("close")).alias("avg_close")).select(
        "sector", F.unix_millis("window.start").alias("timestamp"), "avg_close"
    )


def last_deliveries(bars: DataFrame, delay: str = "2 days") -> DataFrame:
    """The last delivery of every bar, in update mode: what a micro-batch delivers comes out at once.

    State holds one row per (sector, ticker, timestamp) until the watermark passes it.
    Deliveries are ordered by `delivery` if the source has it (a position or an offset),
    else by the micro-batch they come in; the higher price ends a tie.
    """
    order = F.col("delivery") if "delivery" in bars.columns else F.unix_millis(F.current_timestamp())
    numbered = bars.withColumn("delivery", order.cast("long")).withColumn("event_time", F.timestamp_millis("timestamp"))
    timed = numbered.withWatermark("event_time", delay)
    last = F.max(F.struct("delivery", "close")).getField("close")
    return timed.groupBy("sector", "tickerSymbol", "timestamp", "event_time").agg(last.alias("close")).drop("event_time")


def correct_means(deliveries: DataFrame, store: str, version: int) -> None:
    """Put the last deliveries of a micro-batch into the live bars and its means into the results.

    Only the (sector, timestamp) pairs that the batch touches are computed anew, from
    the bars of their days. Both writes are folders of this version, and the means are
    read from the bars as they are after it, so a repeated batch changes nothing.
    """
    spark, bars = deliveries.sparkSession, f"{store}-bars"
    keyed.upsert(deliveries.select(*LIVE_BARS.schema.fieldNames()), bars, version, STREAM, gather=("sector",))
    path = f"{bars}/writer={STREAM}/version={version}"
    touched = spark.read.schema(LIVE_BARS.schema).parquet(path).select("sector", "timestamp").distinct()
    days = [r[0] for r in touched.select(LIVE_BARS.bucket()).distinct().collect()]
    if not days:
        return
    held = keyed.read_current(spark, bars, LIVE_BARS, days)
    pairs = touched.select(F.col("sector").alias("s"), F.col("timestamp").alias("t"))
    means = sector_means(held.join(pairs, F.col("sector").eqNullSafe(F.col("s")) & (F.col("timestamp") == F.col("t")), "left_semi"))
    upsert(live_series(means), store, version, STREAM)


def correct_stream(
    bars: DataFrame, store: str, checkpoint: str, every: str | None = None, delay: str = "2 days", compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """A live view with corrections: means are out with the batch that delivers a bar, and again when one changes.

    A repeated delivery counts once, the last one of a bar replaces the ones before it.
    Bars later than the delay are left out and counted (`losses`).
    """
    first = next_version(bars.sparkSession, store)

    def write(batch: DataFrame, batch_id: int) -> None:
        correct_means(batch, store, first + batch_id)
        if (batch_id + 1) % compact_every == 0:
            keyed.compact(batch.sparkSession, f"{store}-bars", LIVE_BARS)
            results.compact(batch.sparkSession, store)

    writer = last_deliveries(bars, delay).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return triggered(writer.foreachBatch(write), every).start()


def losses(query: StreamingQuery) -> int:
    """Rows that the watermark of a query has left out, over its recent progress."""
    return sum(op["numRowsDroppedByWatermark"] for step in query.recentProgress for op in step["stateOperators"])


def live_series(means: DataFrame) -> DataFrame:
    """Live means in the result schema, with the instant as text."""
    return overlay(
        means.select(
            "sector",
            F.lit("streaming").alias("scope"),
            format_instant(F.col("timestamp")).alias("timestamp"),
            "avg_close",
        )
    )


def triggered(writer, every: str | None):
    """`None` handles what is there and ends."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def upsert_stream(
    means: DataFrame,
    store: str,
    checkpoint: str,
    every: str | None = None,
    mode: str = "update",
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Upsert the live series into a result store, batch by batch.

    `every=None` handles what is there and ends; `every="15 minutes"` keeps going.
    Versions count up from the newest of the store, so a batch that is repeated
    after a restart, or a new checkpoint, puts its rows above the older ones.
    """
    first = next_version(means.sparkSession, store)

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(live_series(batch), store, first + batch_id, STREAM)
        if (batch_id + 1) % compact_every == 0:
            results.compact(batch.sparkSession, store)

    writer = means.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return triggered(writer, every).start()


def memory_table(means: DataFrame, name: str, every: str | None = None) -> StreamingQuery:
    """The sorted live series as a named in-memory table, for tests and displays."""
    writer = (
        means.sort("sector", "timestamp").writeStream.outputMode("complete").format("memory").queryName(name)
    )
    return triggered(writer, every).start()


def console(frame: DataFrame, every: str | None = None, mode: str = "append") -> StreamingQuery:
    """Print every micro-batch."""
    return triggered(frame.writeStream.outputMode(mode).format("console"), every).start()


def broker_sink(
    records: DataFrame, servers: str, checkpoint: str, every: str | None = "1 second"
) -> StreamingQuery:
    """Send records to the topic each of them names."""
    writer = (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, every).start()


def append_files(
    frame: DataFrame, path: str, checkpoint: str, partition_by=(), every: str | None = None
) -> StreamingQuery:
    """Append a stream to Parquet files, once per row."""
    writer = frame.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return triggered(writer, every).start()


def count_words(lines: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds") -> StreamingQuery:
    """Word counts of each micro-batch on its own, under `{path}/batch=N`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        word_count(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return triggered(writer, every).start()
