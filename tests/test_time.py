import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketflow.functions import (
    bucket_start,
    epoch_ms,
    format_date,
    format_instant,
    lookback_start,
    next_business_day,
    round_half_up,
    weekday,
)
from marketflow.schema import DAY_MS
from tests.conftest import rows

UTC = dt.timezone.utc


def ms(*parts):
    return int(dt.datetime(*parts, tzinfo=UTC).timestamp() * 1000)


def python_time(value):
    return dt.datetime.fromtimestamp(value / 1000, UTC)


@pytest.fixture
def instants(spark):
    days = [ms(2023, 11, d, 14, 30) for d in range(20, 30)]
    values = days + [0, -1, ms(1969, 12, 31), ms(2024, 2, 29, 23, 59, 59), ms(2024, 12, 31)]
    return spark.createDataFrame([(v,) for v in values], "t long"), values


def test_weekday_and_business_day(instants):
    frame, values = instants
    got = rows(frame, "t", weekday(F.col("t")), next_business_day(F.col("t")))
    expected = []
    for v in sorted(values):
        following = python_time(v + DAY_MS).weekday()
        step = DAY_MS * (8 - following) if following > 4 else DAY_MS
        expected.append((v, python_time(v).weekday(), v + step))
    assert got == expected


def test_friday_to_sunday_all_lead_to_monday(spark):
    friday, saturday, sunday = ms(2024, 1, 5), ms(2024, 1, 6), ms(2024, 1, 7)
    frame = spark.createDataFrame([(friday,), (saturday,), (sunday,)], "t long")
    assert {r[0] for r in rows(frame, next_business_day(F.col("t")))} == {ms(2024, 1, 8)}


def test_texts(instants):
    frame, values = instants
    got = rows(frame, "t", format_date(F.col("t")), format_instant(F.col("t")))
    for value, date, instant in got:
        assert date == python_time(value).strftime("%Y-%m-%d")
        at = python_time(value)
        assert instant == at.strftime("%Y-%m-%dT%H:%M:%S.") + f"{value % 1000:03d}+0000"


def test_nulls_stay_null(spark):
    frame = spark.createDataFrame([(None,)], "t long")
    t = F.col("t")
    picked = [format_date(t), format_instant(t), weekday(t), next_business_day(t), bucket_start(t, 1, "day")]
    assert rows(frame, *picked) == [(None,) * 5]


@pytest.mark.parametrize("multiplier,unit", [(15, "minute"), (1, "hour"), (1, "day"), (3, "day"), (2, "week")])
def test_fixed_buckets(instants, multiplier, unit):
    frame, _ = instants
    width = multiplier * {"minute": 60_000, "hour": 3_600_000, "day": DAY_MS, "week": 7 * DAY_MS}[unit]
    for value, start in rows(frame, "t", bucket_start(F.col("t"), multiplier, unit)):
        assert start <= value < start + width
        assert (start - (4 * DAY_MS if unit == "week" else 0)) % width == 0


def test_calendar_buckets(instants):
    frame, _ = instants
    t = F.col("t")
    for value, month, quarter, year in rows(
        frame, "t", bucket_start(t, 1, "month"), bucket_start(t, 1, "quarter"), bucket_start(t, 1, "year")
    ):
        at = python_time(value)
        assert python_time(month) == dt.datetime(at.year, at.month, 1, tzinfo=UTC)
        assert python_time(quarter) == dt.datetime(at.year, (at.month - 1) // 3 * 3 + 1, 1, tzinfo=UTC)
        assert python_time(year) == dt.datetime(at.year, 1, 1, tzinfo=UTC)


def test_bad_buckets_are_refused():
    with pytest.raises(ValueError):
        bucket_start(F.col("t"), 1, "fortnight")
    with pytest.raises(ValueError):
        bucket_start(F.col("t"), 0, "day")


def test_look_back_follows_the_calendar(spark):
    frame = spark.createDataFrame([(ms(2024, 2, 29, 12),)], "t long")
    got = rows(frame, lookback_start(F.col("t"), "5 YEARS"), lookback_start(F.col("t"), "2 DAYS"))
    assert got == [(ms(2019, 2, 28, 12), ms(2024, 2, 27, 12))]


def test_epoch_of_both_timestamp_types(spark):
    frame = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.678' a, timestamp'2024-01-02 03:04:05.678' b")
    assert rows(frame, epoch_ms(F.col("a")), epoch_ms(F.col("b"))) == [(ms(2024, 1, 2, 3, 4, 5) + 678,) * 2]


def test_rounding_of_half_cents(spark):
    frame = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (0.1 + 0.2,), (None,)], "v double")
    got = {r[0]: r[1] for r in rows(frame, "v", round_half_up(F.col("v"), 2))}
    assert got == {1.005: 1.01, 2.675: 2.68, -1.005: -1.01, 0.1 + 0.2: 0.3, None: None}
