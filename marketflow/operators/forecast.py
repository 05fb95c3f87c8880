"""The recursive forecast of the next business days, as one Spark job.

The newest `window_size - 1` bars of a ticker are averaged; the mean becomes the
open, high and low of the next day, its score the close; the new day enters the
window, the oldest bar leaves it, and so on. The close never feeds back, so the
feature days are folded first and scored once, whatever the horizon. The mean is
taken before the pending day joins the window: days one and two are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions import next_business_day
from marketflow.operators.models import FEATURES, score
from marketflow.operators.ranking import last_n_strict
from marketflow.operators.series import sector_ends
from marketflow.schema import WINDOW_SIZE
from marketflow.session import settle


def recent_windows(frame: DataFrame, window_size: int = WINDOW_SIZE) -> DataFrame:
    """One row per (sector, ticker): its newest bars as an array, oldest first.

    An array holds at most `window_size - 1` bars.
    """
    if window_size < 2:
        raise ValueError("window_size must be at least 2")
    values = ["open", "high", "low", "close"]
    newest = last_n_strict(
        frame.select("sector", "tickerSymbol", "timestamp", *values),
        window_size,
        keys=("sector", "tickerSymbol"),
        ties=values,
    )
    bar = F.struct("timestamp", *values)
    return newest.groupBy("sector", "tickerSymbol").agg(F.array_sort(F.collect_list(bar)).alias("window"))


def _mean(values: Column) -> Column:
    """The mean of the values that are not null; null if there are none."""
    known = F.filter(values, lambda x: x.isNotNull())
    return F.aggregate(known, F.lit(0.0), lambda total, x: total + x) / F.nullif(F.size(known), F.lit(0))


def slide_means(window: Column, distinct_window: Column, window_size: int, horizon: int) -> Column:
    """The next `horizon` means of one column, each entering the window in turn.

    `window` is the plain history; from its first extension on, the history
    counts without duplicate bars.
    """
    keep = window_size - 1
    first = _mean(window)
    start = F.struct(
        F.concat(distinct_window, F.array(first)).alias("window"), F.array(first, first).alias("means")
    )

    def newest(values: Column) -> Column:
        return F.slice(values, F.greatest(F.size(values) - keep, F.lit(0)) + 1, keep)

    def step(state: Column, _k: Column) -> Column:
        pending = F.element_at(state["means"], -1)
        return F.struct(
            F.concat(newest(state["window"]), F.array(pending)).alias("window"),
            F.concat(state["means"], F.array(_mean(newest(state["window"])))).alias("means"),
        )

    if horizon <= 2:
        return F.slice(start["means"], 1, horizon)
    return F.aggregate(F.sequence(F.lit(3), F.lit(horizon)), start, step, lambda state: state["means"])


def business_days(last_ms: Column, horizon: int) -> Column:
    """The `horizon` business days after an instant, as an array."""
    return F.slice(
        F.aggregate(
            F.sequence(F.lit(1), F.lit(horizon)),
            F.array(last_ms),
            lambda days, _k: F.concat(days, F.array(next_business_day(F.element_at(days, -1)))),
        ),
        2,
        horizon,
    )


def forecast_features(
    frame: DataFrame, window_size: int = WINDOW_SIZE, horizon: int | None = None
) -> DataFrame:
    """Open, high and low of the next `horizon` business days for every ticker.

    Dates follow the newest bar of the whole sector, also for a ticker whose own
    bars end earlier. The bars are read once: the windows, one row per ticker,
    are settled, and the newest bar of a sector is found among them.
    """
    horizon = window_size if horizon is None else horizon
    windows = settle(recent_windows(frame, window_size), "windows")
    own_ends = windows.select("sector", F.element_at("window.timestamp", -1).alias("timestamp"))
    dated = windows.withColumn("distinct_window", F.array_distinct("window")).join(
        sector_ends(own_ends), "sector"
    )
    folded = dated.select(
        "sector",
        "tickerSymbol",
        business_days(F.col("max_timestamp"), horizon).alias("timestamp"),
        *[
            slide_means(F.col(f"window.{c}"), F.col(f"distinct_window.{c}"), window_size, horizon).alias(c)
            for c in FEATURES
        ],
    )
    days = F.posexplode(F.arrays_zip("timestamp", *FEATURES)).alias("position", "day")
    return folded.select("sector", "tickerSymbol", days).select(
        "sector", "tickerSymbol", (F.col("position") + 1).alias("step"), "day.*"
    )


def forecast(
    frame: DataFrame, coefficients: DataFrame, window_size: int = WINDOW_SIZE, horizon: int | None = None
) -> DataFrame:
    """The forecast days with their predicted close."""
    return score(forecast_features(frame, window_size, horizon), coefficients)
