import random

from pyspark.sql import functions as F

from marketflow.operators import ranking as R
from tests.conftest import rows

SCHEMA = "tickerSymbol string, timestamp long, id long"


def sample(seed=1, size=600):
    draw = random.Random(seed)
    keys = ["HOT"] * 6 + ["A", "B", None]
    times = [None] + list(range(0, 5000, 37))
    return [(draw.choice(keys), draw.choice(times), i) for i in range(size)]


def ranked(data):
    """Newest first per key; null times last; the id breaks ties."""
    out = {}
    for key in {k for k, _, _ in data}:
        own = [r for r in data if r[0] == key]
        own.sort(key=lambda r: (r[1] is None, -(r[1] or 0), -r[2]))
        out.update({r[2]: n for n, r in enumerate(own, start=1)})
    return out


def test_rank_newest_over_slices(spark):
    data = sample()
    frame = spark.createDataFrame(data, SCHEMA).repartition(5)
    for slice_ms in (50, 1000, 10**9):
        got = dict(rows(R.rank_newest(frame, ties=("id",), slice_ms=slice_ms), "id", "row_num"))
        assert got == ranked(data)


def test_rank_keeps_columns_and_takes_several_keys(spark):
    frame = spark.createDataFrame([("a", 1, 10), ("a", 1, 20), ("a", 2, 10)], "s string, k int, timestamp long")
    got = R.rank_newest(frame, keys=("s", "k"), slice_ms=7)
    assert rows(got) == [("a", 1, 10, 2), ("a", 1, 20, 1), ("a", 2, 10, 1)]


def test_last_n_against_brute_force(spark):
    data = sample(seed=2)
    frame = spark.createDataFrame(data, SCHEMA).repartition(7)
    for n in (1, 6, 9, 1000):
        ranks = ranked(data)
        got = sorted(r["id"] for r in R.last_n(frame, n, ties=("id",)).collect())
        assert got == sorted(i for i, rank in ranks.items() if rank <= n)


def test_strict_keeps_one_fewer(spark):
    frame = spark.range(30).select(F.lit("A").alias("tickerSymbol"), F.col("id").alias("timestamp"))
    assert [t for _, t in rows(R.last_n_strict(frame, 10))] == list(range(21, 30))


def test_last_n_with_copies_of_one_row(spark):
    hot = spark.range(5000).select(F.lit("A").alias("tickerSymbol"), F.lit(7).cast("long").alias("timestamp"))
    assert rows(R.last_n(hot, 3)) == [("A", 7)] * 3


def test_moving_mean(spark):
    frame = spark.createDataFrame([("A", i, float(i)) for i in range(6)] + [("B", 0, 4.0)], "tickerSymbol string, timestamp long, close double")
    got = [m for *_, m in rows(R.moving_mean(frame, 4))]
    assert got == [0.0, 0.5, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_document_ids_count_from_zero(spark):
    series = spark.createDataFrame(
        [("tech", "historical", "2024-01-02"), ("tech", "historical", "2024-01-01"), ("tech", "prediction", "2024-01-03")],
        "sector string, scope string, timestamp string",
    )
    assert rows(R.document_ids(series), "index", "id", "timestamp") == [
        ("tech_historical", 0, "2024-01-01"),
        ("tech_historical", 1, "2024-01-02"),
        ("tech_prediction", 0, "2024-01-03"),
    ]


def test_latest(spark):
    frame = spark.range(100).withColumnRenamed("id", "timestamp")
    assert [r[0] for r in R.latest(frame).collect()] == list(range(99, 79, -1))
