"""The one-step forecast merged into the history by a full outer join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.operators.models import FEATURES, score
from marketflow.operators.ranking import last_n
from marketflow.operators.series import sector_ends
from marketflow.schema import DAY_MS, ONE_STEP_ROWS
from marketflow.session import settle

JOIN_KEYS = ("sector", "tickerSymbol", *FEATURES)


def ticker_means(frame: DataFrame, rows: int = ONE_STEP_ROWS) -> DataFrame:
    """Means of the newest `rows` bars of every ticker, and the sector's newest time.

    The bars are read once; the means, one row per ticker, are settled.
    """
    newest = last_n(
        frame.select("sector", "tickerSymbol", "timestamp", *FEATURES),
        rows,
        keys=("sector", "tickerSymbol"),
        ties=FEATURES,
    )
    per_ticker = newest.groupBy("sector", "tickerSymbol").agg(
        *[F.avg(c).alias(c) for c in FEATURES],
        F.avg("timestamp").alias("mean_timestamp"),
        F.max("timestamp").alias("timestamp"),
    )
    settled = settle(per_ticker, "means")
    return settled.drop("timestamp").join(sector_ends(settled), "sector")


def predict_next(frame: DataFrame, coefficients: DataFrame, rows: int = ONE_STEP_ROWS) -> DataFrame:
    """One predicted row per ticker."""
    return score(ticker_means(frame, rows), coefficients).drop("mean_timestamp")


def full_join(history: DataFrame, predicted: DataFrame) -> DataFrame:
    """Full outer join of history and prediction on ticker and features.

    The predicted side has one row per ticker, so the join splits without loss
    into a left join plus the predictions that no bar matched. Both halves keep
    the history in place while the predicted side is small enough for Spark to
    broadcast; beyond that they are merge joins whose hot keys AQE may split,
    which it cannot do for a full outer join.
    """
    keys = list(JOIN_KEYS)
    matched = history.join(predicted.select(*keys, "prediction"), keys, "left")
    met = history.select(*keys).join(predicted.select(*keys), keys, "left_semi").distinct()
    unmatched = predicted.join(met, keys, "left_anti")
    return matched.select(*keys, "close", "timestamp", "prediction").unionByName(
        unmatched.select(*keys, "prediction", "max_timestamp"), allowMissingColumns=True
    )


def fill_missing(joined: DataFrame) -> DataFrame:
    """Fill the gaps of the full join: the day after the sector's newest bar, and zeros."""
    next_day = F.col("max_timestamp") + F.lit(DAY_MS)
    return (
        joined.withColumn("timestamp", F.coalesce("timestamp", next_day))
        .fillna({"close": 0.0, "prediction": 0.0})
        .drop("max_timestamp")
    )


def next_day_view(history: DataFrame, predicted: DataFrame) -> DataFrame:
    """History and prediction by ticker and time, with gaps left null."""
    next_day = F.col("max_timestamp") + F.lit(DAY_MS)
    return history.select("sector", "tickerSymbol", "timestamp", "close").unionByName(
        predicted.select("sector", "tickerSymbol", next_day.alias("timestamp"), "prediction"),
        allowMissingColumns=True,
    )
