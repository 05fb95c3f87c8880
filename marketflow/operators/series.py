"""Sector lookup, sector means and the series built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions import format_date, mean_2dp
from marketflow.schema import RESULT_SCHEMA
from marketflow.session import settle


def with_sector(frame: DataFrame, dimension: DataFrame) -> DataFrame:
    """Add `sector` by ticker; a ticker outside the dimension belongs to none and is left out.

    No hint: Spark broadcasts the dimension while its known size is below
    `spark.sql.autoBroadcastJoinThreshold` and merges beyond it, with AQE
    splitting a hot ticker.
    """
    return frame.join(dimension, "tickerSymbol")


def assign_sectors(frame: DataFrame, dimension: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bars with a sector, bars without): none is lost on the way.

    A `sector` that the frame brings (from the folder of a delivery) counts first, then
    the dimension's. Bars without sector, ticker or time are the second frame.
    """
    own = F.col("sector") if "sector" in frame.columns else F.lit(None).cast("string")
    known = dimension.select("tickerSymbol", F.col("sector").alias("_known"))
    named = frame.withColumn("_own", own).drop("sector").join(known, "tickerSymbol", "left")
    named = named.withColumn("sector", F.coalesce("_own", "_known")).drop("_own", "_known")
    whole = F.col("sector").isNotNull() & F.col("tickerSymbol").isNotNull() & F.col("timestamp").isNotNull()
    return named.where(whole), named.where(~whole)


def sector_mean(frame: DataFrame, value: str, name: str | None = None) -> DataFrame:
    """Mean of `value` per sector and timestamp over the tickers present."""
    return frame.groupBy("sector", "timestamp").agg(mean_2dp(F.col(value)).alias(name or f"avg_{value}"))


def published_series(frame: DataFrame, value: str, scope: str, name: str | None = None) -> DataFrame:
    """The daily mean as the dashboard gets it: date text, two decimals.

    Left unsorted, since most uses merge or write it; `in_order` sorts it.
    """
    column = name or f"avg_{value}"
    return sector_mean(frame, value, column).select(
        "sector",
        F.lit(scope).alias("scope"),
        format_date(F.col("timestamp")).alias("timestamp"),
        column,
    )


def in_order(series: DataFrame) -> DataFrame:
    """A series by sector and ascending timestamp."""
    return series.orderBy("sector", "timestamp")


def sector_max_timestamp(frame: DataFrame) -> DataFrame:
    """Newest timestamp of each sector."""
    return frame.groupBy("sector").agg(F.max("timestamp").alias("max_timestamp"))


def sector_ends(frame: DataFrame) -> DataFrame:
    """The newest timestamps, settled: one row per sector of known size.

    Joined back it is broadcast, so that no task gathers the tickers of a sector.
    """
    return settle(sector_max_timestamp(frame), "ends")


def multi_mean(frame: DataFrame) -> DataFrame:
    """Means of close and prediction together; only the close is rounded."""
    return frame.groupBy("sector", "timestamp").agg(
        mean_2dp(F.col("close")).alias("avg_close"), F.avg("prediction").alias("avg_prediction")
    )


def completeness(frame: DataFrame, dimension: DataFrame) -> DataFrame:
    """Tickers present per sector and timestamp against the tickers expected.

    The frame holds one row per (ticker, timestamp), so a plain count is enough.
    """
    expected = dimension.groupBy("sector").agg(F.count(F.lit(1)).alias("expected"))
    present = frame.groupBy("sector", "timestamp").agg(F.count(F.lit(1)).alias("present"))
    return present.join(expected, "sector").withColumn("complete", F.col("present") >= F.col("expected"))


def overlay(*series: DataFrame) -> DataFrame:
    """History, forecast and live series as one table of the result schema."""
    first, *rest = series
    merged = first
    for other in rest:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged.select(
        *[
            (F.col(f.name) if f.name in merged.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RESULT_SCHEMA
        ]
    )


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union by column name, without duplicates."""
    return first.unionByName(second).distinct()
