"""Growing files as a stream: lines are read on from the byte where the last batch ended.

The offset of the source is, for every file, the byte up to which its whole lines are
read, and how often it has been written anew. A file that has become shorter, or whose
bytes before that position are no longer the ones that were read, has been rewritten
and comes again from its beginning. Positions live in the query's checkpoint, so a
restart goes on in the middle of a file.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: bytes before a position by which a file is known again, bytes of a task, and bytes looked through for a line's end
PRINT_BYTES, PART_BYTES, LOOK_BYTES = 256, 64 << 20, 1 << 16
#: bytes that a file's position may grow by before deliveries of its next writing would mix with it
GENERATION = 1 << 44


class Range(InputPartition):
    """Whole lines that begin inside [start, end) of a file."""

    def __init__(self, path: str, start: int, end: int, generation: int, last: int):
        self.path, self.start, self.end, self.generation, self.last = path, start, end, generation, last


def _opened(root: str) -> tuple[pafs.FileSystem, str]:
    system, path = pafs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (pafs.LocalFileSystem(), root)
    return system, path.rstrip("/")


def _slice(system: pafs.FileSystem, path: str, start: int, end: int) -> bytes:
    with system.open_input_file(path) as file:
        return file.read_at(max(0, end - start), start) if end > start else b""


def _print_of(system: pafs.FileSystem, path: str, position: int) -> str:
    """What the bytes just before a position are known by."""
    return hashlib.blake2b(_slice(system, path, max(0, position - PRINT_BYTES), position), digest_size=16).hexdigest()


def _end_of_lines(system: pafs.FileSystem, path: str, start: int, size: int) -> int:
    """The byte after the last line feed in [start, size); `start` if there is none."""
    end = size
    while end > start:
        begin = max(start, end - LOOK_BYTES)
        at = _slice(system, path, begin, end).rfind(b"\n")
        if at >= 0:
            return begin + at + 1
        end = begin
    return start


class TailReader(DataSourceStreamReader):
    """Reads `{root}/{folder}/*{suffix}`; see the module."""

    def __init__(self, root: str, suffix: str, part_bytes: int):
        self.root, self.suffix, self.part_bytes = root, suffix, part_bytes
        self.known: dict[str, dict] = {}

    def initialOffset(self) -> dict:
        return {"files": {}}

    def _files(self) -> list[pafs.FileInfo]:
        system, path = _opened(self.root)
        found = system.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
        # one folder below the root; a leading _ or . marks what is being written
        deep = [f for f in found if f.is_file and f.path[len(path) :].strip("/").count("/") == 1]
        hidden = lambda f: any(part[:1] in "_." for part in f.path[len(path) :].strip("/").split("/"))
        return sorted((f for f in deep if f.path.endswith(self.suffix) and not hidden(f)), key=lambda f: f.path)

    def latestOffset(self) -> dict:
        system, _ = _opened(self.root)
        for info in self._files():
            was = self.known.get(info.path)
            seen = {"size": info.size, "mtime": str(info.mtime_ns)}
            if was is not None and {k: was.get(k) for k in seen} == seen:
                continue
            position, generation = (was["position"], was["generation"]) if was else (0, 0)
            if was and (info.size < position or _print_of(system, info.path, position) != was["print"]):
                position, generation = 0, generation + 1
            position = _end_of_lines(system, info.path, position, info.size)
            self.known[info.path] = {"position": position, "generation": generation, "print": _print_of(system, info.path, position), **seen}
        return {"files": dict(self.known)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        before, parts = start.get("files", {}), []
        # after a restart the positions of the checkpoint are where the next batch begins
        self.known = {**before, **end["files"], **{p: k for p, k in self.known.items() if p not in before and p not in end["files"]}}
        for path, now in end["files"].items():
            was = before.get(path, {"position": 0, "generation": 0})
            at = was["position"] if was["generation"] == now["generation"] else 0
            for begin in range(at, now["position"], self.part_bytes):
                parts.append(Range(path, begin, min(begin + self.part_bytes, now["position"]), now["generation"], now["position"]))
        return parts

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        system, _ = _opened(self.root)
        with system.open_input_file(partition.path) as file:
            # a line belongs to the range that it begins in: look at the byte before, read past the end
            start = partition.start
            if start and file.read_at(1, start - 1) != b"\n":
                start = _next_line(file, start, partition.last)
            end = partition.end
            if end < partition.last and file.read_at(1, end - 1) != b"\n":
                end = _next_line(file, end, partition.last)
            lines = file.read_at(end - start, start).split(b"\n")[:-1] if end > start else []
        topic = partition.path.split("/")[-2]
        delivery, at = [], start + GENERATION * partition.generation
        for line in lines:
            delivery.append(at)
            at += len(line) + 1
        text = [line.decode("utf-8", "replace") for line in lines]
        yield pa.RecordBatch.from_arrays(
            [pa.array(text, pa.string()), pa.array([topic] * len(lines), pa.string()), pa.array(delivery, pa.int64())],
            names=["value", "topic", "delivery"],
        )


def _next_line(file, start: int, last: int) -> int:
    """Where the next line begins at or after a position inside a line."""
    while start < last:
        held = file.read_at(min(LOOK_BYTES, last - start), start)
        at = held.find(b"\n")
        if at >= 0:
            return start + at + 1
        start += len(held)
    return last


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "value string, topic string, delivery long"

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options["path"], self.options.get("suffix", ".txt"), int(self.options.get("partBytes", PART_BYTES)))


def tail_sector_tree(spark: SparkSession, root: str, suffix: str = ".txt", part_bytes: int = PART_BYTES) -> DataFrame:
    """The lines of `{root}/{sector}/*.txt` as they are appended, as records of topic = sector.

    A line comes once, when its line feed is there; a rewritten file comes again as a
    whole. `delivery` rises with every line of a file and with every new writing of it.
    The root must be a path that driver and executors share, local or of a file system
    that pyarrow reaches. A file is listed as long as it is there; one that is gone keeps its position.
    """
    spark.dataSource.register(TailSource)
    stream = spark.readStream.format("growing_lines").option("suffix", suffix).option("partBytes", part_bytes).load(root)
    return stream.select("value", "topic", F.col("delivery"))
