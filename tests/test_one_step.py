import pytest
from pyspark.sql import functions as F

from marketflow.operators import one_step as O
from marketflow.operators.series import multi_mean
from marketflow.schema import DAY_MS, small_frame
from tests.conftest import rows

SCHEMA = "sector string, tickerSymbol string, timestamp long, open double, high double, low double, close double"
COLUMNS = ["sector", "tickerSymbol", "open", "high", "low", "close", "timestamp", "prediction"]


@pytest.fixture
def history(spark):
    data = [("s", "A", i * DAY_MS, 10.0 + i * i, 12.0 + i * i, 9.0 + i * i, 11.0 + i * i) for i in range(9)]
    data += [("s", "FLAT", i * DAY_MS, 5.0, 6.0, 4.0, 5.5) for i in range(3)]
    data += [("s", "HOLE", 0, None, 6.0, 4.0, 5.5)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def predicted(spark, history):
    coefficients = {"sector": ["s"], "intercept": [1.0], "coef_open": [1.0], "coef_high": [0.0], "coef_low": [0.0]}
    return O.predict_next(history, small_frame(spark, coefficients))


def test_means_of_the_last_seven(history):
    got = {r["tickerSymbol"]: r for r in O.ticker_means(history).collect()}
    assert got["A"]["open"] == 39.0 and got["A"]["mean_timestamp"] == 5 * DAY_MS
    assert got["FLAT"]["max_timestamp"] == 8 * DAY_MS


def test_split_join_is_the_full_join(history, predicted):
    keys = list(O.JOIN_KEYS)
    whole = history.join(predicted.select(*keys, "prediction"), keys, "full")
    assert rows(O.full_join(history, predicted), *COLUMNS) == rows(whole, *COLUMNS)


def test_equal_features_merge_and_the_rest_is_filled(history, predicted):
    filled = O.fill_missing(O.full_join(history, predicted))
    flat = rows(filled.filter("tickerSymbol = 'FLAT'"), "timestamp", "close", "prediction")
    assert flat == [(i * DAY_MS, 5.5, 6.0) for i in range(3)]
    ahead = rows(filled.filter("tickerSymbol = 'A' and close = 0"), "timestamp", "prediction")
    assert ahead == [(9 * DAY_MS, 40.0)]
    assert filled.filter("tickerSymbol = 'A' and close > 0 and prediction <> 0").count() == 0


def test_view_keeps_gaps_null(history, predicted):
    means = {r["timestamp"]: r for r in multi_mean(O.next_day_view(history, predicted)).collect()}
    assert means[8 * DAY_MS]["avg_close"] == 75.0 and means[8 * DAY_MS]["avg_prediction"] is None
    assert means[9 * DAY_MS]["avg_close"] is None and means[9 * DAY_MS]["avg_prediction"] is not None


def test_a_hot_group_of_equal_bars(spark, predicted):
    hot = spark.range(5000).select(
        F.lit("s").alias("sector"), F.lit("FLAT").alias("tickerSymbol"), F.col("id").alias("timestamp"),
        F.lit(5.0).alias("open"), F.lit(6.0).alias("high"), F.lit(4.0).alias("low"), F.lit(5.5).alias("close"),
    )
    joined = O.full_join(hot, predicted)
    assert joined.filter("tickerSymbol = 'FLAT' and prediction = 6.0").count() == 5000
    assert joined.count() == 5002
