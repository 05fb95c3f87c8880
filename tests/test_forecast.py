import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketflow.operators import forecast as FC
from marketflow.schema import DAY_MS, small_frame
from tests.conftest import rows

SCHEMA = "sector string, tickerSymbol string, timestamp long, open double, high double, low double, close double"
COEF = {"sector": ["s"], "intercept": [1.0], "coef_open": [0.5], "coef_high": [0.25], "coef_low": [0.25]}
MONDAY = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)


def next_day(ms):
    day = dt.datetime.fromtimestamp((ms + DAY_MS) / 1000, dt.timezone.utc).weekday()
    return ms + DAY_MS * (8 - day if day > 4 else 1)


def recursion(data, size, horizon):
    """The forecast step by step, on plain lists: one pending row per ticker."""
    last = max(r[2] for r in data)
    histories = {}
    for row in data:
        histories.setdefault(row[1], []).append(tuple(row[2:6]) + (row[6],))
    out = []
    for ticker, history in histories.items():
        def newest(values):
            return sorted(values, reverse=True)[: size - 1]

        def mean(values):
            return [sum(v[i] for v in sorted(values)) / len(values) for i in (1, 2, 3)]

        kept = newest(history)
        pending = mean(kept)
        stamp = last
        for step in range(1, horizon + 1):
            means = mean(newest(kept))
            stamp = next_day(stamp)
            close = 1.0 + 0.5 * pending[0] + 0.25 * pending[1] + 0.25 * pending[2]
            out.append((ticker, step, stamp, *pending))
            kept = sorted(set(newest(kept)) | {(stamp, *pending, close)})
            pending = means
    return sorted(out)


def history(seed, tickers, most):
    draw = random.Random(seed)
    data = []
    for t in range(tickers):
        for day in range(draw.randint(1, most)):
            low = draw.uniform(10, 20)
            data.append(("s", f"T{t}", MONDAY + day * DAY_MS, low + 1, low + 3, low, low + 2))
    return data


def check(spark, data, size, horizon):
    frame = spark.createDataFrame(data, SCHEMA)
    got = rows(FC.forecast_features(frame, size, horizon), "tickerSymbol", "step", "timestamp", "open", "high", "low")
    expected = recursion(data, size, horizon)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    for g, e in zip(got, expected):
        assert g[3:] == pytest.approx(e[3:], abs=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 999), size=st.integers(2, 12), horizon=st.integers(1, 14))
def test_against_the_recursion(spark, seed, size, horizon):
    check(spark, history(seed, 3, 15), size, horizon)


@pytest.mark.parametrize("size", [2, 3, 10, 12])
def test_default_horizon_is_the_window(spark, size):
    data = history(5, 2, 15)
    got = FC.forecast_features(spark.createDataFrame(data, SCHEMA), size)
    assert got.groupBy("tickerSymbol").count().agg(F.min("count"), F.max("count")).first() == (size, size)


def test_duplicate_bars_count_once_after_the_first_step(spark):
    data = history(7, 1, 4)
    data = data + [data[-1], data[-1]]
    check(spark, data, 5, 6)


def test_first_two_days_are_equal(spark):
    got = rows(FC.forecast_features(spark.createDataFrame(history(1, 1, 9), SCHEMA), 4), "step", "open", "high", "low")
    assert got[0][1:] == got[1][1:] != got[2][1:]


def test_dates_follow_the_sector_and_skip_weekends(spark):
    friday = MONDAY + 4 * DAY_MS
    data = [("s", "A", friday, 1.0, 1.0, 1.0, 1.0), ("s", "B", MONDAY, 2.0, 2.0, 2.0, 2.0)]
    got = FC.forecast_features(spark.createDataFrame(data, SCHEMA), 3)
    days = {r["tickerSymbol"]: r["d"] for r in got.groupBy("tickerSymbol").agg(F.sort_array(F.collect_list("timestamp")).alias("d")).collect()}
    assert days["A"] == days["B"] == [friday + DAY_MS * n for n in (3, 4, 5)]


def test_close_is_the_score(spark):
    frame = FC.forecast(spark.createDataFrame(history(2, 2, 8), SCHEMA), small_frame(spark, COEF), 4)
    for row in frame.collect():
        assert row["prediction"] == pytest.approx(1 + 0.5 * row["open"] + 0.25 * row["high"] + 0.25 * row["low"])


def test_window_of_one_is_refused(spark):
    with pytest.raises(ValueError):
        FC.recent_windows(spark.createDataFrame([], SCHEMA), 1)


def test_no_bars_no_forecast(spark):
    assert FC.forecast_features(spark.createDataFrame([], SCHEMA), 4).collect() == []


def test_means_skip_nulls(spark):
    frame = spark.sql("select array(1D, null, 3D) as some, cast(array(null, null) as array<double>) as none")
    got = frame.select(FC._mean(F.col("some")), FC._mean(F.col("none"))).first()
    assert tuple(got) == (2.0, None)
