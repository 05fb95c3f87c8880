"""Landing without losses, and cycles that the live job follows."""

import json

import pytest

from marketflow.plans.landing import feed_deliveries, land_deliveries
from marketflow.plans.live import run_live
from marketflow.sinks.feed import publish_cycle
from marketflow.sinks.results import read_current
from marketflow.sources.files import read_landed_bars, read_sector_tree
from marketflow.streaming.sources import follow_sector_tree
from tests.conftest import rows
from tests.test_files import wire
from tests.test_streaming import BAR, START, text


@pytest.fixture
def raw(tmp_path):
    def deliver(name, *bars):
        for sector, ticker, *values in bars:
            folder = tmp_path / name / sector
            folder.mkdir(parents=True, exist_ok=True)
            with (folder / f"{ticker}.txt").open("a") as out:
                out.write(json.dumps(wire(ticker, *values)) + "\n")
        return str(tmp_path / name)

    return deliver


def test_the_folder_names_the_sector_and_the_rest_is_rejected(spark, raw, tmp_path):
    # XOM is in no dimension but in a sector's folder; one bar has no time
    root = raw("in", ("energy", "XOM", 1, 5.0), ("energy", "CVX", 1, 6.0), ("energy", "CVX", None, 7.0))
    land_deliveries(read_sector_tree(spark, root), str(tmp_path / "out"))
    landed = read_landed_bars(spark, str(tmp_path / "out"))
    assert rows(landed, "sector", "tickerSymbol", "close") == [("energy", "CVX", 6.0), ("energy", "XOM", 5.0)]
    rejected = spark.read.json(str(tmp_path / "out-rejects"))
    assert rows(rejected, "tickerSymbol", "close") == [("CVX", 7.0)]


def test_without_folders_unknown_tickers_are_rejected(spark, raw, tmp_path):
    bars = read_sector_tree(spark, raw("in", ("energy", "XOM", 1, 5.0), ("energy", "CVX", 1, 6.0))).drop("sector")
    land_deliveries(bars, str(tmp_path / "out"), str(tmp_path / "left"))
    assert rows(read_landed_bars(spark, str(tmp_path / "out")), "tickerSymbol") == [("CVX",)]
    assert rows(spark.read.json(str(tmp_path / "left")), "tickerSymbol", "close") == [("XOM", 5.0)]


def test_a_landed_ticker_is_one_file(spark, raw, tmp_path):
    root = raw("in", *[("tech", ticker, day * 86_400_000, 5.0) for ticker in ("IBM", "AAPL") for day in range(60)])
    land_deliveries(read_sector_tree(spark, root), str(tmp_path / "out"))
    for ticker in ("IBM", "AAPL"):
        assert len(list((tmp_path / "out" / "sector=tech" / f"tickerSymbol={ticker}").glob("part-*"))) == 1


def test_land_live_land_again_live(spark, raw, tmp_path):
    feed, store = str(tmp_path / "feed"), str(tmp_path / "store")

    def run():
        for query in run_live(follow_sector_tree(spark, feed), store, str(tmp_path / "checkpoint"), every=None):
            query.awaitTermination()
        return rows(read_current(spark, store), "sector", "timestamp", "avg_close")

    first = read_sector_tree(spark, raw("one", ("tech", "IBM", START, 50.0), ("tech", "AAPL", START, 100.0), ("energy", "XOM", START, 7.0)))
    assert feed_deliveries(first, feed, "c1")
    expected = [("energy", text(START), 7.0), ("tech", text(START), 75.0)]
    assert run() == expected
    # the next cycle corrects a bar and brings a new one
    second = read_sector_tree(spark, raw("two", ("tech", "IBM", START, 60.0), ("tech", "IBM", START + BAR, 61.0)))
    assert feed_deliveries(second, feed, "c2")
    expected = [expected[0], ("tech", text(START), 80.0), ("tech", text(START + BAR), 61.0)]
    assert run() == expected
    # a cycle that is out is not published again
    assert not feed_deliveries(second, feed, "c2")
    assert run() == expected


def test_a_cycle_that_broke_off_is_completed(spark, raw, tmp_path):
    feed = tmp_path / "feed"
    bars = read_sector_tree(spark, raw("one", ("tech", "IBM", START, 50.0), ("energy", "CVX", START, 7.0)))
    assert publish_cycle(bars, str(feed), "c1")
    published = sorted(p.relative_to(feed).as_posix() for p in feed.glob("*/*.txt"))
    assert published == ["energy/c1-0-0.txt", "tech/c1-0-0.txt"]
    (feed / "_published" / "c1").unlink()
    (feed / "tech" / "c1-0-0.txt").unlink()
    assert publish_cycle(bars, str(feed), "c1")
    assert sorted(p.relative_to(feed).as_posix() for p in feed.glob("*/*.txt")) == published
    assert rows(read_sector_tree(spark, str(feed)), "sector", "tickerSymbol") == [("energy", "CVX"), ("tech", "IBM")]
    assert not (feed / "_staged" / "c1").exists()
