"""The keyed table: snapshots, compaction beside readers, bounded folders; bars, models and ranks built on it."""

import json

import pytest
from pyspark.sql import functions as F

from marketflow.operators import ranking
from marketflow.operators.ranking import rank_by_ranges, rank_newest
from marketflow.schema import DAY_MS
from marketflow.session import settle
from marketflow.sinks import keyed
from marketflow.sinks import results as store
from marketflow.streaming import bars as streamed
from tests.conftest import rows
from tests.test_files import series
from tests.test_streaming import BAR, START


def folders(path):
    return len(list(path.glob("writer=*/version=*"))) + len(list(path.glob("_base/*"))) + len(list(path.glob("_current/[0-9]*")))


def test_folders_stay_bounded_over_a_hundred_versions(spark, tmp_path):
    path, most = tmp_path / "store", 0
    for version in range(100):
        month = f"2024-{version % 3 + 1:02d}"
        rows_of = [("s", "x", f"{month}-{day:02d}", float(version)) for day in (1, version % 28 + 1)]
        store.upsert(series(spark, *set(rows_of)), str(path), version, store.STREAM)
        if version % 10 == 9:
            assert store.compact(spark, str(path))
            most = max(most, folders(path))
    assert most <= 30
    expected = {}
    for version in range(100):
        for day in (1, version % 28 + 1):
            expected[f"2024-{version % 3 + 1:02d}-{day:02d}"] = float(version)
    assert rows(store.read_current(spark, str(path)), "timestamp", "avg_close") == sorted(expected.items())
    assert store.next_version(spark, str(path)) == 100


def test_a_reader_goes_on_while_the_table_is_compacted(spark, tmp_path):
    path = str(tmp_path / "store")
    for version in range(3):
        store.upsert(series(spark, ("s", "x", "2024-01-01", float(version)), ("s", "x", f"2024-02-0{version + 1}", 1.0)), path, version)
    held = store.read_current(spark, path)
    assert store.compact(spark, path)
    store.upsert(series(spark, ("s", "x", "2024-01-01", 9.0)), path, 3)
    assert store.compact(spark, path)
    assert rows(held, "timestamp", "avg_close")[0] == ("2024-01-01", 2.0) and held.count() == 4
    assert rows(store.read_current(spark, path), "timestamp", "avg_close")[0] == ("2024-01-01", 9.0)


def test_only_touched_buckets_are_written_again(spark, tmp_path):
    path = tmp_path / "store"
    store.upsert(series(spark, ("s", "x", "2024-01-01", 1.0), ("s", "x", "2024-02-01", 1.0)), str(path), 0)
    store.compact(spark, str(path))
    store.upsert(series(spark, ("s", "x", "2024-02-01", 2.0)), str(path), 1)
    store.compact(spark, str(path))
    second = max(path.glob("_base/*"), key=lambda p: p.name)
    assert [p.name for p in second.glob("bucket=*")] == ["bucket=2024-02"]
    assert rows(store.read_current(spark, str(path)), "timestamp", "avg_close") == [("2024-01-01", 1.0), ("2024-02-01", 2.0)]


def test_two_compactions_that_meet(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    store.upsert(series(spark, ("s", "x", "2024-01-01", 1.0)), path, 0)
    create = keyed.Folder.create

    def beaten(folder, name, text):
        monkeypatch.setattr(keyed.Folder, "create", create)
        assert store.compact(spark, path)  # another one is faster
        return create(folder, name, text)

    monkeypatch.setattr(keyed.Folder, "create", beaten)
    assert not store.compact(spark, path)
    assert len(list((tmp_path / "store" / "_base").iterdir())) == 1
    assert rows(store.read_current(spark, path), "avg_close") == [(1.0,)]


def test_unfinished_versions_and_half_written_snapshots(spark, tmp_path):
    path = tmp_path / "store"
    for version in range(3):
        store.upsert(series(spark, ("s", "x", f"2024-01-0{version + 1}", 1.0)), str(path), version)
    (path / "writer=batch" / "version=1" / "_SUCCESS").unlink()
    assert store.compact(spark, str(path))
    assert json.loads((path / "_current" / "000000000001").read_text())["folded"] == {"batch": 0}
    (path / "_current" / "000000000009").write_text('{"folded"')
    assert store.read_current(spark, str(path)).count() == 3


def test_an_empty_table_and_a_wanted_bucket(spark, tmp_path):
    path = str(tmp_path / "none")
    assert store.read_current(spark, path).count() == 0 and not store.compact(spark, path)
    store.upsert(series(spark, ("s", "x", "2024-01-01", 1.0), ("s", "x", "2024-02-01", 2.0), ("s", "x", None, 3.0)), path, 0)
    for _ in range(2):
        assert keyed.read_current(spark, path, store.LAYOUT, ["2024-02"]).count() == 1
        assert keyed.read_current(spark, path, store.LAYOUT, ["none", "2030-01"]).count() == 1
        store.compact(spark, path)


def ticks(spark, *values):
    return spark.createDataFrame(list(values), "tickerSymbol string, timestamp long, price double, volume long, seq long")


def test_open_and_close_of_a_bar_change_with_ticks_out_of_order(spark, tmp_path):
    path = str(tmp_path / "ticks")

    def run(*values):
        ticks(spark, *values).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema("tickerSymbol string, timestamp long, price double, volume long, seq long").parquet(path)
        streamed.upsert_bars(streamed.stream_bars(stream), str(tmp_path / "bars"), str(tmp_path / "checkpoint")).awaitTermination()
        return rows(streamed.read_live_bars(spark, str(tmp_path / "bars")), "tickerSymbol", "timestamp", "open", "high", "low", "close", "volume", "numberOfItems")

    at = lambda ms: START + ms
    assert run(("A", at(60_000), 5.0, 1, 2), ("A", at(120_000), 7.0, 1, 3)) == [("A", START, 5.0, 7.0, 5.0, 7.0, 2, 2)]
    assert run(("A", at(30_000), 9.0, 2, 1)) == [("A", START, 9.0, 9.0, 5.0, 7.0, 4, 3)]
    second = ("B", START + BAR, 3.0, 3.0, 3.0, 3.0, 1, 1)
    assert run(("A", at(130_000), 1.0, 1, 4), ("B", START + BAR, 3.0, 1, 1)) == [("A", START, 9.0, 9.0, 1.0, 1.0, 5, 4), second]


def test_a_published_model_counts_from_the_next_batch_on(spark, tmp_path):
    frame = "sector string, open double, high double, low double"
    models = str(tmp_path / "models")

    def publish(sector, intercept):
        columns = "sector string, intercept double, coef_open double, coef_high double, coef_low double"
        streamed.publish_models(spark.createDataFrame([(sector, intercept, 1.0, 0.0, 0.0)], columns), models)

    def run(value):
        spark.createDataFrame([("tech", value, 0.0, 0.0)], frame).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(frame).parquet(str(tmp_path / "in"))
        streamed.score_stream(stream, models, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        return rows(spark.read.schema(frame + ", prediction double").parquet(str(tmp_path / "out")), "open", "prediction")

    publish("tech", 1.0)
    assert run(1.0) == [(1.0, 2.0)]
    publish("energy", 7.0)  # another sector's model leaves this one
    assert run(2.0) == [(1.0, 2.0), (2.0, 3.0)]
    publish("tech", 5.0)
    assert run(3.0) == [(1.0, 2.0), (2.0, 3.0), (3.0, 8.0)]


@pytest.mark.parametrize("hot", ["day", "null"])
def test_a_hot_slice_is_ranked_by_many_tasks(spark, monkeypatch, hot):
    placed = []
    monkeypatch.setattr(ranking, "settle", lambda frame, label: placed.append(settle(frame, label)) or placed[-1])
    time = F.when(F.col("id") % 2 == 0, F.lit(5 * DAY_MS if hot == "day" else None).cast("long")).otherwise(F.col("id") * 7919 % (30 * DAY_MS))
    key = F.when(F.col("id") % 4 < 3, "hot").when(F.col("id") % 8 == 3, F.concat(F.lit("k"), F.col("id") % 5))
    frame = spark.range(20_000).select(key.alias("tickerSymbol"), time.alias("timestamp"), F.col("id").alias("tie"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        ranked = rank_by_ranges(frame, ties=("tie",))
        sizes = [r["n"] for r in placed[0].groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(sizes) >= 12 and max(sizes) < 20_000 / 6
    assert rows(ranked) == rows(rank_newest(frame, ties=("tie",)))
