"""Parquet tables seen as ticks: one price and one volume at one instant.

Columns: `tickerSymbol`, `timestamp` (epoch ms), `price`, `volume` and `seq`, the
order of the ticks inside a bar. `seq` is a long or a decimal on purpose: the
first and last price of a bar then fit a hash aggregation, whereas a struct as
the order would force a sort of all ticks before the shuffle.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.functions import epoch_ms
from marketflow.operators.bars import within
from marketflow.schema import TICKER_SECTOR
from marketflow.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of the data folder."""
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


LookBack = tuple[int, str]


def _source(spark: SparkSession, sf_dir: str, name: str, ts: str, look_back: LookBack | None) -> DataFrame:
    """A table, cut to a look-back on its own time column so that the scan skips the rest."""
    rows = table(spark, sf_dir, name)
    return rows if look_back is None else within(rows, *look_back, ts)


def event_ticks(spark: SparkSession, sf_dir: str, look_back: LookBack | None = None) -> DataFrame:
    """`events` as ticks of the thirty tickers; `look_back` is (end in ms, interval)."""
    return events_as_ticks(_source(spark, sf_dir, "events", "ts", look_back))


def events_as_ticks(events: DataFrame) -> DataFrame:
    """Rows of `events`, batch or stream, as ticks."""
    symbols = F.array(*[F.lit(symbol) for symbol in TICKER_SECTOR])
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.element_at(symbols, (F.col("user_id") % len(TICKER_SECTOR) + 1).cast("int")).alias(
            "tickerSymbol"
        ),
        F.unix_millis(ts).alias("timestamp"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("long").alias("volume"),
        (
            F.unix_micros(ts).cast("decimal(17,0)") * F.lit(Decimal(10**19))
            + F.col("event_id").cast("decimal(19,0)")
        ).alias("seq"),
    )


def line_item_ticks(spark: SparkSession, sf_dir: str, look_back: LookBack | None = None) -> DataFrame:
    """`lineitem` as ticks of its suppliers; ship dates carry no time of day.

    Lines of one day follow their order and line number; that pair repeats, so
    the price, to a millionth, ends the order. Prices of 9e12 and more are equal in it.
    """
    price = F.col("l_extendedprice") / F.col("l_quantity")
    line = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("decimal(19,0)")
    return _source(spark, sf_dir, "lineitem", "l_shipdate", look_back).select(
        F.col("l_suppkey").cast("string").alias("tickerSymbol"),
        epoch_ms(F.col("l_shipdate")).alias("timestamp"),
        price.alias("price"),
        F.col("l_quantity").cast("long").alias("volume"),
        (line * F.lit(Decimal(10**19)) + F.floor(F.least(price, F.lit(9e12)) * 1_000_000).cast("decimal(19,0)")).alias("seq"),
    )


def supplier_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`tickerSymbol -> sector` for suppliers: the region of their nation."""
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").cast("string").alias("tickerSymbol"), F.col("r_name").alias("sector"))
    )
