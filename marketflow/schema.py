"""Schemas and the ticker dimension shared by every part of the library."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DAY_MS = 86_400_000

# The wire format of a bar. Every measure appears under its short
# key and, `vw` apart, again under a long name.
BAR_SCHEMA = T.StructType(
    [
        T.StructField("v", T.LongType()),
        T.StructField("vw", T.DoubleType()),
        T.StructField("o", T.DoubleType()),
        T.StructField("c", T.DoubleType()),
        T.StructField("h", T.DoubleType()),
        T.StructField("l", T.DoubleType()),
        T.StructField("t", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("tickerSymbol", T.StringType()),
        T.StructField("volume", T.LongType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("numberOfItems", T.LongType()),
    ]
)

# One row of the serving table, history, forecast and live series alike.
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("sector", T.StringType()),
        T.StructField("scope", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("avg_close", T.DoubleType()),
        T.StructField("avg_prediction", T.DoubleType()),
    ]
)

# The texts of a day and of an instant.
DATE_FORMAT = "yyyy-MM-dd"
INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSZ"

# The six sectors, also the topic and index names.
SECTORS = ("cgoods", "financial", "energy", "health", "industrial", "tech")

# The thirty companies and the sector of each.
TICKER_SECTOR = {
    "CVX": "energy",
    "AXP": "financial",
    "AMGN": "health",
    "AAPL": "tech",
    "BA": "industrial",
    "CAT": "industrial",
    "CSCO": "tech",
    "GS": "financial",
    "HD": "cgoods",
    "HON": "tech",
    "IBM": "tech",
    "INTC": "tech",
    "JNJ": "health",
    "KO": "cgoods",
    "JPM": "financial",
    "MCD": "cgoods",
    "MMM": "industrial",
    "MRK": "health",
    "MSFT": "tech",
    "NKE": "cgoods",
    "PG": "health",
    "TRV": "financial",
    "UNH": "health",
    "CRM": "tech",
    "VZ": "tech",
    "V": "financial",
    "WBA": "health",
    "WMT": "cgoods",
    "DIS": "industrial",
    "DOW": "industrial",
}

# The regression and window settings of the daily and of the one-step forecast.
ELASTIC_NET = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.7}
ONE_STEP_ELASTIC_NET = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8}

WINDOW_SIZE = 10
ONE_STEP_ROWS = 7

# What the two feeds ask for, as (multiplier, unit, look-back).
DAILY_FEED = (1, "day", "5 YEARS")
INTRADAY_FEED = (15, "minute", "2 DAYS")


def small_frame(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A literal frame from a few values per column.

    Made from an Arrow table it is a local relation: Spark knows its exact size
    and broadcasts it by its own threshold. From a list of rows its size would be
    unknown, and joins would shuffle or broadcast the other side.
    """
    return spark.createDataFrame(pa.table(columns))


def ticker_dimension(spark: SparkSession) -> DataFrame:
    """The 30-row lookup `tickerSymbol -> sector`."""
    return small_frame(
        spark, {"tickerSymbol": list(TICKER_SECTOR), "sector": list(TICKER_SECTOR.values())}
    )
