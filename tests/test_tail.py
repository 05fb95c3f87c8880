"""Growing files: appended, rewritten, half-written, after a restart."""

import json

import pytest

from marketflow.plans.live import run_live
from marketflow.sinks.results import read_current
from marketflow.streaming.live import append_files
from marketflow.streaming.tail import TailReader, tail_sector_tree
from tests.conftest import rows
from tests.test_files import wire
from tests.test_streaming import START, text


@pytest.fixture
def tree(tmp_path):
    for sector in ("tech", "energy"):
        (tmp_path / "raw" / sector).mkdir(parents=True)
    return tmp_path / "raw"


def drained(reader, start):
    """(end offset, lines by topic) of what a reader finds after an offset."""
    end = reader.latestOffset()
    found = [r for part in reader.partitions(start, end) for b in reader.read(part) for r in b.to_pylist()]
    return end, [(r["topic"], r["value"]) for r in found]


@pytest.mark.parametrize("part_bytes", [1, 3, 7, 1000])
def test_every_line_once_whatever_the_ranges(tree, part_bytes):
    file = tree / "tech" / "A.txt"
    lines = ["one", "", "three é", "x" * 50, "five"]
    file.write_text("\n".join(lines) + "\nhalf a li")
    reader = TailReader(str(tree), ".txt", part_bytes)
    end, got = drained(reader, reader.initialOffset())
    assert got == [("tech", line) for line in lines]
    with file.open("a") as more:
        more.write("ne\nseven\n")
    end, got = drained(reader, end)
    assert got == [("tech", "half a line"), ("tech", "seven")]
    assert drained(reader, end)[1] == []


def test_a_new_reader_goes_on_in_the_middle_and_knows_rewritten_files(tree):
    first, second = tree / "tech" / "A.txt", tree / "energy" / "B.txt"
    first.write_text("a\nb\n")
    second.write_text("c\nd\n")
    reader = TailReader(str(tree), ".txt", 1000)
    end, got = drained(reader, reader.initialOffset())
    assert len(got) == 4
    restarted = TailReader(str(tree), ".txt", 1000)
    assert restarted.partitions(reader.initialOffset(), json.loads(json.dumps(end)))  # as Spark does on a restart
    with first.open("a") as more:
        more.write("e\n")
    second.write_text("C\nd\nf\n")
    end, got = drained(restarted, end)
    assert got == [("energy", "C"), ("energy", "d"), ("energy", "f"), ("tech", "e")]
    second.write_text("g\n")
    (tree / "tech" / "_staged.txt").write_text("hidden\n")
    (tree / "tech" / "note.log").write_text("other\n")
    end, got = drained(restarted, end)
    assert got == [("energy", "g")]
    second.unlink()
    assert drained(restarted, end)[1] == []


def test_an_empty_or_missing_folder(tmp_path):
    reader = TailReader(str(tmp_path / "none"), ".txt", 10)
    assert drained(reader, reader.initialOffset()) == ({"files": {}}, [])


def test_a_stream_resumes_in_mid_file(spark, tree, tmp_path):
    file = tree / "tech" / "AAPL.txt"

    def run():
        append_files(tail_sector_tree(spark, str(tree)), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        out = spark.read.schema("value string, topic string, delivery long").parquet(str(tmp_path / "out"))
        return [r[0] for r in out.orderBy("delivery").select("value").collect()]

    file.write_text("1\n2\n")
    assert run() == ["1", "2"]
    with file.open("a") as more:
        more.write("3\n4")
    assert run() == ["1", "2", "3"]
    with file.open("a") as more:
        more.write("\n5\n")
    assert run() == ["1", "2", "3", "4", "5"]
    assert run() == ["1", "2", "3", "4", "5"]
    file.write_text("1\n9\n")
    assert run() == ["1", "2", "3", "4", "5", "1", "9"]


def test_live_means_follow_a_growing_and_a_rewritten_file(spark, tree, tmp_path):
    file, store = tree / "tech" / "AAPL.txt", str(tmp_path / "store")

    def run():
        for query in run_live(tail_sector_tree(spark, str(tree)), store, str(tmp_path / "checkpoint"), every=None):
            query.awaitTermination()
        return rows(read_current(spark, store), "sector", "timestamp", "avg_close")

    line = lambda price: json.dumps(wire("AAPL", START, price)) + "\n"
    file.write_text(line(100.0))
    assert run() == [("tech", text(START), 100.0)]
    with file.open("a") as more:
        more.write(line(90.0) + line(80.0))
    assert run() == [("tech", text(START), 80.0)]
    file.write_text(line(70.0))
    assert run() == [("tech", text(START), 70.0)]
