"""Bars: building, re-bucketing, range selection, de-duplication, wire format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions import bucket_start, lookback_start
from marketflow.schema import BAR_SCHEMA


def bars(ticks: DataFrame, multiplier: int = 1, unit: str = "day", keys=("tickerSymbol",)) -> DataFrame:
    """Open/high/low/close bars of `multiplier` units from ticks.

    Every aggregate has a fixed-width buffer, so this is one hash aggregation
    with a map-side combine: a ticker that holds a third of all ticks reaches
    the shuffle as one row per bar and task.
    """
    weighted = F.col("price") * F.col("volume")
    return (
        ticks.withColumn("timestamp", bucket_start(F.col("timestamp"), multiplier, unit))
        .groupBy(*keys, "timestamp")
        .agg(
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
            F.sum("volume").alias("volume"),
            F.try_divide(F.sum(weighted), F.sum("volume")).alias("vw"),
            F.count(F.lit(1)).alias("numberOfItems"),
        )
    )


def rebucket(
    frame: DataFrame, multiplier: int, unit: str, keys=("tickerSymbol",)
) -> DataFrame:
    """Wider bars from narrower ones; `(keys, timestamp)` must be unique."""
    weighted = F.col("vw") * F.col("volume")
    return (
        frame.withColumn("_from", F.col("timestamp"))
        .withColumn("timestamp", bucket_start(F.col("timestamp"), multiplier, unit))
        .groupBy(*keys, "timestamp")
        .agg(
            F.min_by("open", "_from").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "_from").alias("close"),
            F.sum("volume").alias("volume"),
            F.try_divide(F.sum(weighted), F.sum("volume")).alias("vw"),
            F.sum("numberOfItems").alias("numberOfItems"),
        )
    )


def within(frame: DataFrame, end_ms: int, interval: str, ts: str = "timestamp") -> DataFrame:
    """Rows of the look-back `[end - interval, end]`, both ends included.

    `ts` holds epoch milliseconds or a timestamp. The bare column is compared
    with constants of its own type, so the predicate reaches the scan.
    """
    end = F.lit(end_ms).cast("long")
    start = lookback_start(end, interval)
    kind = frame.schema[ts].dataType.simpleString()
    if kind.startswith("timestamp"):
        start, end = (F.timestamp_millis(edge).cast(kind) for edge in (start, end))
    return frame.filter(F.col(ts).between(start, end))


def request_bars(
    ticks: DataFrame, multiplier: int, unit: str, end_ms: int, interval: str, ticker: str | None = None
) -> DataFrame:
    """The bar request of the feed: ticker, multiplier, unit and range."""
    wanted = within(ticks, end_ms, interval)
    if ticker is not None:
        wanted = wanted.filter(F.col("tickerSymbol") == ticker)
    return bars(wanted, multiplier, unit)


def dedup_bars(frame: DataFrame, keys=("tickerSymbol", "timestamp"), prefer=()) -> DataFrame:
    """One row per key out of repeated deliveries.

    The greatest row wins, compared by `prefer` first and then by the other
    columns, so the outcome does not depend on arrival. Copies collapse on the
    map side, however many there are of one bar.
    """
    order = [*prefer, *[c for c in frame.columns if c not in keys and c not in prefer]]
    best = frame.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_best"))
    return best.select(*[c if c in keys else F.col(f"_best.{c}").alias(c) for c in frame.columns])


def to_wire(frame: DataFrame, *extra: str) -> DataFrame:
    """Bars in the sixteen-field wire format, after any `extra` columns."""
    sources = {
        "v": "volume",
        "vw": "vw",
        "o": "open",
        "c": "close",
        "h": "high",
        "l": "low",
        "t": "timestamp",
        "n": "numberOfItems",
    }
    return frame.select(
        *extra,
        *[
            F.col(sources.get(field.name, field.name)).cast(field.dataType).alias(field.name)
            for field in BAR_SCHEMA
        ],
    )
