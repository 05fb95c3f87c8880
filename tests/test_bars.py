import random

import pytest
from pyspark.sql import functions as F

from marketflow.operators import bars as B
from marketflow.schema import BAR_SCHEMA, DAY_MS
from tests.conftest import rows

TICK = "tickerSymbol string, timestamp long, price double, volume long, seq long"


@pytest.fixture
def ticks(spark):
    return spark.createDataFrame(
        [
            ("A", 10, 5.0, 2, 1),
            ("A", 10, 4.0, 1, 2),
            ("A", 900_000 - 1, 6.0, 3, 3),
            ("A", 900_000, 7.0, 1, 4),
            ("B", DAY_MS + 5, 1.0, 0, 5),
            ("B", DAY_MS + 6, 2.0, 0, 6),
        ],
        TICK,
    )


def test_bars(ticks):
    got = rows(B.bars(ticks, 15, "minute"), "tickerSymbol", "timestamp", "open", "high", "low", "close", "volume", "numberOfItems")
    assert got == [
        ("A", 0, 5.0, 6.0, 4.0, 6.0, 6, 3),
        ("A", 900_000, 7.0, 7.0, 7.0, 7.0, 1, 1),
        ("B", DAY_MS, 1.0, 2.0, 1.0, 2.0, 0, 2),
    ]


def test_weighted_price_and_bar_without_volume(ticks):
    got = {r["tickerSymbol"]: r["vw"] for r in B.bars(ticks, 1, "day").collect()}
    assert got["A"] == pytest.approx((5 * 2 + 4 + 6 * 3 + 7) / 7)
    assert got["B"] is None


def test_rebucket_equals_direct_bars(spark, small):
    from marketflow.sources.ticks import event_ticks

    source = event_ticks(spark, small)
    wide = B.rebucket(B.bars(source, 15, "minute"), 1, "day")
    columns = ["tickerSymbol", "timestamp", "open", "high", "low", "close", "volume", "numberOfItems"]
    assert rows(wide, *columns) == rows(B.bars(source, 1, "day"), *columns)


def test_against_brute_force_with_a_hot_ticker(spark):
    draw = random.Random(4)
    names = ["HOT", "HOT", "A", "B", "C", "D"]
    data = [
        (draw.choice(names), draw.randrange(5 * DAY_MS), draw.randint(100, 9999) / 100, draw.randint(0, 9), i)
        for i in range(3000)
    ]
    expected = {}
    for name, ms, price, volume, seq in sorted(data, key=lambda r: r[4]):
        group = expected.setdefault((name, ms - ms % DAY_MS), [])
        group.append((price, volume))
    columns = ["tickerSymbol", "timestamp", "open", "high", "low", "close", "volume", "numberOfItems"]
    got = rows(B.bars(spark.createDataFrame(data, TICK).repartition(8), 1, "day"), *columns)
    assert got == [
        (*key, ticks[0][0], max(ticks)[0], min(ticks)[0], ticks[-1][0], sum(v for _, v in ticks), len(ticks))
        for key, ticks in sorted(expected.items())
    ]


def test_empty(spark, ticks):
    assert B.bars(ticks.limit(0)).collect() == []


def test_within_includes_both_ends(spark):
    end = 10 * DAY_MS
    frame = spark.createDataFrame([(end - 2 * DAY_MS - 1,), (end - 2 * DAY_MS,), (end,), (end + 1,)], "timestamp long")
    assert rows(B.within(frame, end, "2 DAYS")) == [(end - 2 * DAY_MS,), (end,)]
    timed = frame.select(F.timestamp_millis("timestamp").cast("timestamp_ntz").alias("timestamp"))
    assert B.within(timed, end, "2 DAYS").count() == 2


def test_request_for_one_ticker(ticks):
    got = B.request_bars(ticks, 1, "day", DAY_MS, "1 DAYS", "A")
    assert rows(got, "tickerSymbol", "timestamp", "numberOfItems") == [("A", 0, 4)]


def test_dedup_prefers_and_does_not_depend_on_order(spark):
    data = [("A", 1, 3, 9.0), ("A", 1, 5, 1.0), ("A", 1, 5, 2.0), ("A", 2, 1, 1.0), ("A", 2, 1, 1.0)]
    for given in (data, data[::-1]):
        frame = spark.createDataFrame(given, "tickerSymbol string, timestamp long, numberOfItems long, close double")
        got = B.dedup_bars(frame, prefer=("numberOfItems",))
        assert got.columns == frame.columns
        assert rows(got) == [("A", 1, 5, 2.0), ("A", 2, 1, 1.0)]


def test_dedup_collapses_a_hot_group_of_copies(spark):
    hot = spark.range(20_000).select(
        F.lit("HOT").alias("tickerSymbol"), F.lit(1).cast("long").alias("timestamp"), (F.col("id") % 3).alias("close")
    )
    assert rows(B.dedup_bars(hot)) == [("HOT", 1, 2)]


def test_wire_format(ticks):
    wire = B.to_wire(B.bars(ticks))
    assert wire.columns == BAR_SCHEMA.fieldNames()
    assert [f.dataType for f in wire.schema] == [f.dataType for f in BAR_SCHEMA]
    for row in wire.collect():
        assert (row.v, row.o, row.c, row.h, row.l, row.t, row.n) == (
            row.volume, row.open, row.close, row.high, row.low, row.timestamp, row.numberOfItems,
        )
