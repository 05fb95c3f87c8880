"""The jobs end to end, through the command line."""

import json
import random
import sys

import pytest

from marketflow import __main__ as cli
from marketflow.operators.bars import bars
from marketflow.plans.landing import land_deliveries, land_request
from marketflow.schema import DAY_MS, INTRADAY_FEED, SECTORS, TICKER_SECTOR
from marketflow.sinks.results import read_current
from marketflow.sources.files import read_bars, read_landed_bars, read_results
from marketflow.sources.ticks import event_ticks
from tests.conftest import rows
from tests.test_files import wire
from tests.test_streaming import START


@pytest.fixture
def deliveries(tmp_path):
    draw = random.Random(11)
    for ticker, sector in TICKER_SECTOR.items():
        folder = tmp_path / "raw" / sector
        folder.mkdir(parents=True, exist_ok=True)
        lines = []
        for day in range(20):
            low = draw.uniform(90, 110)
            prices = {"open": low + 1, "high": low + 3, "low": low, "close": low + draw.random() * 3}
            lines.append(json.dumps(wire(ticker, 1_704_067_200_000 + day * DAY_MS, 1.0, **prices)))
        (folder / f"{ticker}.txt").write_text("\n".join(lines + lines[-1:]) + "\n")
    return tmp_path


def command(monkeypatch, *arguments):
    monkeypatch.setattr(sys, "argv", ["marketflow", *map(str, arguments)])
    cli.main()


def test_land_batch_live(spark, deliveries, monkeypatch):
    at = deliveries
    command(monkeypatch, "land", "--deliveries", at / "raw", "--bars", at / "bars")
    assert read_landed_bars(spark, str(at / "bars")).count() == 600  # copies are gone

    command(monkeypatch, "batch", "--bars", at / "bars", "--models", at / "models", "--results", at / "results")
    results = read_results(spark, str(at / "results"))
    counts = dict(rows(results.groupBy("scope").count()))
    assert counts == {"historical": 6 * 20, "prediction": 6 * 10}
    assert sorted(p.name for p in (at / "models").iterdir()) == sorted(SECTORS)
    forecast = results.filter("scope = 'prediction'")
    assert forecast.filter("avg_prediction is null or avg_prediction not between 90 and 115").count() == 0

    live_files = at / "live" / "tech"
    live_files.mkdir(parents=True)
    (live_files / "AAPL.txt").write_text(json.dumps(wire("AAPL", START, 100.0)) + "\n")
    command(
        monkeypatch, "live", "--files", at / "live", "--results", at / "results", "--store", at / "store",
        "--checkpoint", at / "checkpoint", "--every", "1 second", "--seconds", "25",
    )
    scopes = dict(rows(read_current(spark, str(at / "store")).groupBy("scope").count()))
    assert scopes == {"historical": 120, "prediction": 60, "streaming": 1}


def test_landing_a_request(spark, small, tmp_path):
    ticks = event_ticks(spark, small)
    end = 1_705_276_800_000
    land_request(ticks, str(tmp_path), end, INTRADAY_FEED)
    wanted = bars(ticks.filter(f"timestamp between {end - 2 * DAY_MS} and {end}"), 15, "minute")
    assert read_landed_bars(spark, str(tmp_path)).count() == wanted.count()


def test_landing_keeps_the_fullest_delivery(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [wire("IBM", 1, 5.0, numberOfItems=1, n=1), wire("IBM", 1, 6.0, numberOfItems=9, n=9)]
    (tmp_path / "in" / "a.txt").write_text("\n".join(map(json.dumps, lines)) + "\n")
    land_deliveries(read_bars(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    assert rows(read_landed_bars(spark, str(tmp_path / "out")), "sector", "tickerSymbol", "close") == [("tech", "IBM", 6.0)]
