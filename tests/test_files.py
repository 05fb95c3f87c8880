import json

import pytest
from pyspark.sql import functions as F

from marketflow.operators.series import overlay
from marketflow.schema import BAR_SCHEMA, TICKER_SECTOR, ticker_dimension
from marketflow.session import build_session, new_path, settle, shared_dir
from marketflow.sinks import files as out
from marketflow.sinks import results as store
from marketflow.sources import files as src
from tests.conftest import rows


def wire(ticker, ts, price, **extra):
    bar = {"v": 10, "vw": price, "o": price, "c": price, "h": price, "l": price, "t": ts, "n": 2}
    bar |= {"tickerSymbol": ticker, "volume": 10, "open": price, "close": price, "high": price, "low": price}
    return bar | {"timestamp": ts, "numberOfItems": 2} | extra


@pytest.fixture
def tree(tmp_path):
    for sector, ticker, close in (("tech", "AAPL", 190), ("tech", "IBM", 150.5), ("energy", "CVX", 140)):
        folder = tmp_path / "raw" / sector
        folder.mkdir(parents=True, exist_ok=True)
        lines = [json.dumps(wire(ticker, i, close)) for i in range(3)]
        (folder / f"{ticker}.txt").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "raw")


def test_whole_prices_stay_doubles(spark, tree):
    frame = src.read_bars(spark, tree)
    assert frame.schema == BAR_SCHEMA
    assert frame.count() == 9 and frame.agg(F.sum("close")).first()[0] == 3 * (190 + 150.5 + 140)


def test_sector_and_ticker_from_the_path(spark, tree, tmp_path):
    bare = wire("X", 9, 1.0)
    del bare["tickerSymbol"]
    (tmp_path / "raw" / "energy" / "XOM.txt").write_text(json.dumps(bare) + "\n")
    got = rows(src.read_sector_tree(spark, tree).groupBy("sector", "tickerSymbol").count())
    assert got == [("energy", "CVX", 3), ("energy", "XOM", 1), ("tech", "AAPL", 3), ("tech", "IBM", 3)]


def test_malformed_missing_and_extra_fields(spark, tmp_path):
    (tmp_path / "bars.txt").write_text('{"close": 5, "unknown": 1}\nnot json\n' + json.dumps(wire("KO", 1, 2.5)) + "\n")
    got = rows(src.read_bars(spark, str(tmp_path)), "tickerSymbol", "close")
    assert got == [("KO", 2.5), (None, 5.0), (None, None)]


def test_landing_replaces_only_the_tickers_at_hand(spark, tree, tmp_path):
    path = str(tmp_path / "landed")
    bars = src.read_bars(spark, tree)
    out.land_bars(bars, ticker_dimension(spark), path)
    assert rows(src.read_landed_bars(spark, path).groupBy("sector").count()) == [("energy", 3), ("tech", 6)]
    out.land_bars(bars.filter("tickerSymbol = 'IBM' and timestamp = 0"), ticker_dimension(spark), path)
    got = src.read_landed_bars(spark, path)
    assert rows(got.groupBy("tickerSymbol").count()) == [("AAPL", 3), ("CVX", 3), ("IBM", 1)]
    plan = got.filter("sector = 'energy'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sector" in plan


def series(spark, *values):
    return overlay(spark.createDataFrame(list(values), "sector string, scope string, timestamp string, avg_close double"))


def test_result_files(spark, tmp_path):
    path = str(tmp_path / "results")
    out.write_results(series(spark, ("tech", "historical", "d1", 1.0), ("energy", "historical", "d1", 2.0)), path)
    out.write_results(series(spark, ("tech", "historical", "d2", 3.0)), path)
    got = rows(src.read_results(spark, path), "sector", "scope", "timestamp", "avg_close")
    assert got == [("energy", "historical", "d1", 2.0), ("tech", "historical", "d2", 3.0)]
    assert (tmp_path / "results" / "sector=tech" / "scope=historical").is_dir()


def test_upsert_takes_the_newest_version_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "store")
    store.upsert(series(spark, ("s", "x", "d1", 1.0), ("s", "x", "d2", 1.0)), path, 0)
    for _ in range(2):
        store.upsert(series(spark, ("s", "x", "d2", 2.0), ("s", "x", "d3", 2.0)), path, 1)
    expected = [("d1", 1.0), ("d2", 2.0), ("d3", 2.0)]
    assert store.next_version(spark, path) == 2 and store.next_version(spark, str(tmp_path / "none")) == 0
    assert rows(store.read_current(spark, path), "timestamp", "avg_close") == expected
    assert store.compact(spark, path) and not store.compact(spark, path)
    assert rows(store.read_current(spark, path), "timestamp", "avg_close") == expected
    assert store.next_version(spark, path) == 2


def test_a_seed_beside_a_running_stream_stays(spark, tmp_path):
    path = str(tmp_path / "store")
    store.upsert(series(spark, ("s", "x", "d1", 1.0)), path, store.next_version(spark, path))
    first = store.next_version(spark, path)
    store.upsert(series(spark, ("s", "x", "d2", 2.0)), path, first, store.STREAM)
    # the seed of the next day takes the version that the stream's next batch has too
    store.upsert(series(spark, ("s", "x", "d3", 3.0), ("s", "x", "d4", 3.0)), path, store.next_version(spark, path))
    store.upsert(series(spark, ("s", "x", "d4", 4.0)), path, first + 1, store.STREAM)
    expected = [("d1", 1.0), ("d2", 2.0), ("d3", 3.0), ("d4", 4.0)]
    assert rows(store.read_current(spark, path), "timestamp", "avg_close") == expected


class FileClient:
    """Stands in for a document index: one file per document id."""

    def __init__(self, root):
        self.root = root

    def index(self, index, id, document):
        with open(f"{self.root}/{index}-{id}.json", "w") as out:
            out.write(document)


def test_documents_are_overwritten_by_position(spark, tmp_path):
    root = str(tmp_path)
    for value in (1.0, 2.0):
        frame = series(spark, ("s", "x", "d1", value), ("s", "x", "d2", value))
        store.index_documents(frame, lambda: FileClient(root))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["s_x-0.json", "s_x-1.json"]
    assert json.loads((tmp_path / "s_x-1.json").read_text()) == {"timestamp": "d2", "avg_close": 2.0}


def test_pretty_documents(spark, tmp_path):
    path = str(tmp_path / "pretty")
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n long")
    out.write_pretty_json(frame, path)
    written = [p.read_text() for p in (tmp_path / "pretty").glob("part-*")]
    assert [text.startswith("{\n") for text in written if text] == [True, True]
    assert rows(src.read_json_documents(spark, path, "name string, n long")) == [("a", 1), ("b", 2)]


def test_show(spark, capfd):
    out.show(spark.range(1))
    assert "id" in capfd.readouterr().out


def test_settle_keeps_schema_and_size(spark):
    settled = settle(spark.range(10).withColumn("part", F.col("id") % 2), partition_by=("part",))
    assert settled.columns == ["id", "part"] and settled.count() == 10
    assert new_path(spark, "x") != new_path(spark, "x")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_must_name_the_shared_folder(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_dimension(spark):
    sizes = dict(rows(ticker_dimension(spark).groupBy("sector").count()))
    assert sizes == {"cgoods": 5, "financial": 5, "energy": 1, "health": 6, "industrial": 5, "tech": 8}
    assert len(TICKER_SECTOR) == 30


def test_session_builder_reuses(spark):
    assert build_session() is spark
