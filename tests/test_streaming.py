import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marketflow.functions import format_instant
from marketflow.operators.models import score
from marketflow.operators.records import parse_records
from marketflow.plans.live import run_live, seed
from marketflow.schema import BAR_SCHEMA, DAY_MS, SECTORS, small_frame
from marketflow.sinks.files import write_results
from marketflow.sinks.results import read_current
from marketflow.streaming import live
from marketflow.streaming import sources as src
from tests.conftest import rows
from tests.test_files import series, wire

START = int(dt.datetime(2024, 1, 2, 9, tzinfo=dt.timezone.utc).timestamp() * 1000)
BAR = live.BAR_MS


def text(ms):
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.000+0000")


class Feed:
    """Drops bar files into `{root}/{sector}/`."""

    def __init__(self, root):
        self.root, self.files = root, 0

    def drop(self, sector, *lines):
        folder = self.root / sector
        folder.mkdir(parents=True, exist_ok=True)
        self.files += 1
        body = "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines)
        staged = self.root / f"staged-{self.files}"
        staged.write_text(body + "\n")
        staged.rename(folder / f"T{self.files}.txt")


@pytest.fixture
def feed(tmp_path):
    feed = Feed(tmp_path / "raw")
    feed.drop("tech", wire("AAPL", START, 100), wire("AAPL", START + BAR, 110))
    feed.drop("tech", wire("IBM", START, 50.0))
    feed.drop("energy", wire("CVX", START, 70.0))
    return feed


def run(spark, feed, tmp_path, **options):
    records = src.follow_sector_tree(spark, str(feed.root), max_files=options.pop("max_files", None))
    for query in run_live(records, str(tmp_path / "store"), str(tmp_path / "checkpoint"), every=None, **options):
        query.awaitTermination()
    return rows(read_current(spark, str(tmp_path / "store")).filter("scope = 'streaming'"), "sector", "timestamp", "avg_close")


EXPECTED = [("energy", text(START), 70.0), ("tech", text(START), 75.0), ("tech", text(START + BAR), 110.0)]


@pytest.mark.parametrize("options", [{"delay": None}, {"dedup": False}])
def test_means_equal_the_batch_twin(spark, feed, tmp_path, options):
    assert run(spark, feed, tmp_path, **options) == EXPECTED


def test_one_file_per_batch_gives_the_same(spark, feed, tmp_path):
    assert run(spark, feed, tmp_path, delay=None, max_files=1) == EXPECTED


def test_restart_reads_only_new_files(spark, feed, tmp_path):
    assert run(spark, feed, tmp_path, delay=None) == EXPECTED
    feed.drop("energy", wire("XOM", START, 90.0))
    changed = [("energy", text(START), 80.0), *EXPECTED[1:]]
    assert run(spark, feed, tmp_path, delay=None) == changed
    assert run(spark, feed, tmp_path, delay=None) == changed


def test_a_new_checkpoint_updates_the_same_store(spark, feed, tmp_path):
    assert run(spark, feed, tmp_path, delay=None, max_files=1) == EXPECTED
    feed.drop("energy", wire("XOM", START, 90.0))
    records = src.follow_sector_tree(spark, str(feed.root))
    for query in run_live(records, str(tmp_path / "store"), str(tmp_path / "other"), every=None, delay=None):
        query.awaitTermination()
    got = rows(read_current(spark, str(tmp_path / "store")), "sector", "timestamp", "avg_close")
    assert got == [("energy", text(START), 80.0), *EXPECTED[1:]]


def test_repeated_delivery_counts_without_dedup(spark, feed, tmp_path):
    feed.drop("tech", wire("IBM", START, 50.0), wire("IBM", START, 50.0))
    got = run(spark, feed, tmp_path, delay=None)
    assert got[1] == ("tech", text(START), 62.5)


def test_means_are_out_at_once_and_corrected(spark, feed, tmp_path):
    feed.drop("tech", wire("IBM", START, 50.0), wire("IBM", START, 50.0))
    # no later bar has to push them out, and copies count once
    assert run(spark, feed, tmp_path, max_files=1) == EXPECTED
    feed.drop("tech", wire("IBM", START, 60.0))
    feed.drop("energy", wire("XOM", START, 90.0))
    corrected = [("energy", text(START), 80.0), ("tech", text(START), 80.0), EXPECTED[2]]
    assert run(spark, feed, tmp_path) == corrected
    assert run(spark, feed, tmp_path) == corrected


def test_every_bar_of_a_delivery_is_published(spark, tmp_path):
    feed = Feed(tmp_path / "raw")
    feed.drop("tech", *[wire("AAPL", START + k * BAR, 100.0 + k) for k in range(200)])
    assert len(run(spark, feed, tmp_path)) == 200


def test_late_bars_are_counted_and_far_ones_rejected(spark, feed, tmp_path):
    feed.drop("tech", wire("IBM", START + 30 * DAY_MS, 1.0), wire("IBM", START + 3000 * DAY_MS, 7.0))
    newest = ("tech", text(START + 30 * DAY_MS), 1.0)
    assert run(spark, feed, tmp_path, dead_letters=str(tmp_path / "dead")) == [*EXPECTED, newest]
    dead = spark.read.schema("value string, topic string").parquet(str(tmp_path / "dead"))
    assert [json.loads(r.value)["close"] for r in dead.collect()] == [7.0]
    # behind the watermark: left out, and told
    feed.drop("energy", wire("XOM", START, 90.0), wire("CVX", START + BAR, 90.0))
    records = src.follow_sector_tree(spark, str(feed.root))
    queries = run_live(records, str(tmp_path / "store"), str(tmp_path / "checkpoint"), every=None)
    for query in queries:
        query.awaitTermination()
    assert live.losses(queries[0]) == 2
    current = read_current(spark, str(tmp_path / "store"))
    assert rows(current, "sector", "timestamp", "avg_close") == [*EXPECTED, newest]


def test_a_batch_that_is_repeated_changes_nothing(spark, tmp_path):
    store = str(tmp_path / "store")
    batch = lambda *values: spark.createDataFrame(list(values), "sector string, tickerSymbol string, timestamp long, close double")
    live.correct_means(batch(("tech", "IBM", START, 1.0), ("tech", "AAPL", START, 3.0)), store, 0)
    for _ in range(2):
        live.correct_means(batch(("tech", "IBM", START, 5.0)), store, 1)
    live.correct_means(batch(), store, 2)
    assert rows(read_current(spark, store), "timestamp", "avg_close") == [(text(START), 4.0)]


def test_malformed_lines_go_to_dead_letters(spark, feed, tmp_path):
    feed.drop("tech", "not json")
    assert run(spark, feed, tmp_path, dedup=False, dead_letters=str(tmp_path / "dead")) == EXPECTED
    dead = spark.read.schema("value string, topic string").parquet(str(tmp_path / "dead"))
    assert rows(dead, "topic", "value") == [("tech", "not json")]


def test_malformed_lines_form_the_null_group_without_delay(spark, feed, tmp_path):
    feed.drop("tech", "not json")
    assert run(spark, feed, tmp_path, delay=None) == [*EXPECTED, ("tech", None, None)]


def test_seeded_store(spark, feed, tmp_path):
    results = str(tmp_path / "results")
    write_results(series(spark, ("tech", "historical", "2024-01-01", 9.0)), results)
    seed(spark, results, str(tmp_path / "store"))
    assert run(spark, feed, tmp_path, delay=None) == EXPECTED
    current = read_current(spark, str(tmp_path / "store"))
    assert rows(current.filter("scope = 'historical'"), "sector", "timestamp", "avg_close") == [("tech", "2024-01-01", 9.0)]


def test_memory_table_in_complete_mode(spark, feed):
    parsed = parse_records(src.follow_sector_tree(spark, str(feed.root)))
    live.memory_table(live.sector_means(live.flatten(parsed)), "live_means").awaitTermination()
    got = spark.sql("SELECT * FROM live_means")
    assert not got.isEmpty()
    listed = [tuple(r) for r in got.select("sector", format_instant(F.col("timestamp")), "avg_close").collect()]
    assert listed == EXPECTED


def test_bar_files_as_a_stream(spark, feed, tmp_path):
    bars = src.follow_bars(spark, str(feed.root), max_files=2)
    assert bars.schema == BAR_SCHEMA
    live.append_files(bars, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.schema(BAR_SCHEMA).parquet(str(tmp_path / "out")).count() == 4


def test_words_are_counted_per_batch(spark, tmp_path):
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.txt").write_text("x y x\n")
    (lines / "b.txt").write_text("x\n")
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(lines))
    live.count_words(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), every=None).awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "out")), "word", "n")
    assert got in ([("x", 1), ("x", 2), ("y", 1)],)


def test_a_stream_is_scored_with_given_models(spark, feed, tmp_path):
    parsed = parse_records(src.follow_sector_tree(spark, str(feed.root)))
    bars = parsed.select(F.col("topic").alias("sector"), "data.open", "data.high", "data.low")
    models = {"sector": ["tech", "energy"], "intercept": [1.0, 0.0]}
    models |= {f"coef_{c}": [1.0, 0.5] for c in ("open", "high", "low")}
    scored = score(bars, small_frame(spark, models))
    live.append_files(scored, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "out")), "sector", "prediction")
    assert got == [("energy", 105.0), ("tech", 151.0), ("tech", 301.0), ("tech", 331.0)]


def test_console(spark, feed):
    live.console(src.follow_bars(spark, str(feed.root)).select("tickerSymbol")).awaitTermination()


def test_interval_trigger_keeps_running(spark, feed, tmp_path):
    means = live.sector_means(live.flatten(parse_records(src.follow_sector_tree(spark, str(feed.root)))))
    query = live.upsert_stream(means, str(tmp_path / "store"), str(tmp_path / "checkpoint"), every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert read_current(spark, str(tmp_path / "store")).count() == 3


def test_broker_options_subscribe_to_all_topics():
    options = src.broker_options("a:1,b:2")
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": ",".join(SECTORS),
        "startingOffsets": "earliest",
    }


def test_any_source_with_value_and_topic_will_do(spark, tmp_path):
    spark.createDataFrame([(b"{}", "tech")], "value binary, topic string").write.parquet(str(tmp_path / "records"))
    spark.conf.set("spark.sql.streaming.schemaInference", "true")
    try:
        stream = src.open_records(spark, "parquet", path=str(tmp_path / "records"))
        assert stream.isStreaming and stream.columns == ["value", "topic"]
    finally:
        spark.conf.unset("spark.sql.streaming.schemaInference")


def test_a_table_is_a_file_or_a_folder(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"x": [1, 2, 3]}), tmp_path / "one.parquet")
    spark.range(5).repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    for name, expected in (("one", 3), ("many", 5)):
        stream = src.follow_table(spark, str(tmp_path), name)
        stream.writeStream.format("memory").queryName(f"table_{name}").trigger(availableNow=True).start().awaitTermination()
        assert spark.table(f"table_{name}").count() == expected
