import json

from pyspark.sql import functions as F

from marketflow.operators import records as J
from marketflow.operators import series as S
from tests.conftest import rows


def records(spark, *pairs):
    return spark.createDataFrame([(bytearray(v.encode()), t) for v, t in pairs], "value binary, topic string")


def test_bad_text_parses_to_nulls(spark):
    frame = records(spark, ('{"close": 262, "timestamp": 5}', "tech"), ("oops", "tech"))
    got = rows(J.parse_records(frame), "data.close", "data.timestamp", "topic")
    assert got == [(262.0, 5, "tech"), (None, None, "tech")]


def test_malformed_records_are_kept_apart(spark):
    good, bad = J.split_malformed(records(spark, ('{"timestamp": 5}', "a"), ("oops", "b"), ('{"close": 1}', "c")))
    assert rows(good, "data.timestamp", "topic") == [(5, "a")]
    assert rows(bad) == [("oops", "b"), ('{"close": 1}', "c")] or rows(bad) == [('{"close": 1}', "c"), ("oops", "b")]


def test_round_trip_through_records(spark):
    frame = spark.createDataFrame([("tech", "IBM", 1, 2.5)], "sector string, tickerSymbol string, timestamp long, close double")
    sent = J.to_records(frame)
    assert sent.columns == ["topic", "value"]
    back = J.parse_records(sent.withColumn("value", F.col("value").cast("binary")))
    assert rows(back, "topic", "data.tickerSymbol", "data.timestamp", "data.close") == [("tech", "IBM", 1, 2.5)]
    assert J.only_topic(sent, "tech").count() == 1 and J.only_topic(sent, "energy").count() == 0


def test_record_key(spark):
    frame = spark.sql("SELECT 'world' hello, named_struct('event', 'message') some_record")
    assert json.loads(J.record_key(frame, "some_record").first()["value"]) == {"event": "message"}


def test_words_keep_empties(spark):
    frame = spark.createDataFrame([("a b  a",), ("",), (None,), (" ",)], "value string")
    assert dict(rows(J.word_count(frame))) == {"a": 2, "b": 1, "": 4}


def test_ragged_means_and_completeness(spark):
    frame = spark.createDataFrame(
        [("A", "s", 1, 1.0), ("B", "s", 1, 2.0), ("A", "s", 2, 5.0)],
        "tickerSymbol string, sector string, timestamp long, close double",
    )
    assert rows(S.sector_mean(frame, "close")) == [("s", 1, 1.5), ("s", 2, 5.0)]
    dimension = frame.select("tickerSymbol", "sector").distinct()
    assert rows(S.completeness(frame, dimension), "timestamp", "present", "expected", "complete") == [
        (1, 2, 2, True),
        (2, 1, 2, False),
    ]


def test_overlay_fills_missing_columns(spark):
    a = spark.createDataFrame([("s", "historical", "d", 1.0)], "sector string, scope string, timestamp string, avg_close double")
    b = spark.createDataFrame([("s", "prediction", "d", 2.0)], "sector string, scope string, timestamp string, avg_prediction double")
    assert rows(S.overlay(a, b)) == [("s", "historical", "d", 1.0, None), ("s", "prediction", "d", None, 2.0)]


def test_union_distinct_goes_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "t string, n int")
    assert rows(S.union_distinct(a, b)) == [(1, "x"), (2, "y")]


def test_unknown_fields_are_kept_as_they_came(spark):
    values = ['{"t": 5, "c": 1.5, "venue": "X", "depth": {"bid": [1, 2]}}', '{"t": 6}', "no record", None, "[1]"]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value string")
    got = J.with_unknown(frame).select(
        "id", "data.t", F.map_keys("unknown").alias("names"), F.to_json(J.unknown_field("depth")).alias("depth")
    )
    found = {r["id"]: (r["t"], r["names"] and sorted(r["names"]), r["depth"]) for r in got.collect()}
    assert found[0] == (5, ["depth", "venue"], '{"bid":[1,2]}')
    assert found[1] == (6, [], None)
    assert all(found[i][0] is None and not found[i][1] and found[i][2] is None for i in (2, 3, 4))
