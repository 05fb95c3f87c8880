"""A keyed table that is upserted version by version, compacted in place and read as of a snapshot.

Every write lands in a folder of its own, `writer=NAME/version=N`. A snapshot is a small
pointer file in `_current`, numbered upwards and created exclusively, so of two
compactions that meet one wins. It names, for each bucket of keys, the folder under
`_base` that holds the bucket's current rows, and for each writer the newest version
that these rows contain. Readers resolve the newest snapshot and add the versions
above it. A compaction merges only the buckets that new versions touch and leaves all
files of the snapshots before it, so readers go on; the next ones delete what the
newest `KEEP` snapshots no longer name.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: snapshots whose files stay, the state before the first one included: a reader outlives KEEP - 1 compactions
KEEP = 3
BATCH, STREAM = "batch", "stream"


@dataclass(frozen=True)
class Layout:
    """What a table holds: its columns, the key of a row, and the bucket a row belongs to, as text."""

    schema: StructType
    key: tuple[str, ...]
    bucket: Callable[[], Column]

    @property
    def values(self) -> list[str]:
        return [name for name in self.schema.fieldNames() if name not in self.key]


@dataclass(frozen=True)
class Snapshot:
    number: int
    folded: dict[str, int]
    buckets: dict[str, str]


class Folder:
    """Files and folders below a path, in whatever store Spark's file systems reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(context._jsc.hadoopConfiguration())
        self._io = context._jvm.org.apache.commons.io.IOUtils

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """What a folder holds, in order; nothing if it is not there."""
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def holds(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file; false if it is there already."""
        if self.holds(name):
            return False
        try:
            stream = self._fs.create(self._at(name), False)
        except Exception:  # Java's error of a file that appeared in between
            if self.holds(name):
                return False
            raise
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        return True

    def rename(self, name: str, to: str) -> bool:
        return self._fs.rename(self._at(name), self._at(to))

    def make(self, name: str) -> None:
        self._fs.mkdirs(self._at(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def _snapshots(folder: Folder) -> list[Snapshot]:
    """All readable snapshots, oldest first; one that is just being written is left out."""
    found = []
    for name in folder.names("_current"):
        if re.fullmatch(r"\d+", name):
            try:
                held = json.loads(folder.text(f"_current/{name}"))
            except ValueError:
                continue
            found.append(Snapshot(int(name), held["folded"], held["buckets"]))
    return found


def _newest(folder: Folder) -> Snapshot:
    return (_snapshots(folder) or [Snapshot(0, {}, {})])[-1]


def _versions(folder: Folder) -> dict[str, list[int]]:
    """The version folders of each writer."""
    numbers = lambda names: sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
    return {w.removeprefix("writer="): numbers(folder.names(w)) for w in folder.names() if w.startswith("writer=")}


def next_version(spark: SparkSession, path: str) -> int:
    """The version above all that the table has seen; a writer's name has one writer at a time."""
    folder = Folder(spark, path)
    seen = [n for numbers in _versions(folder).values() for n in numbers] + list(_newest(folder).folded.values())
    return max(seen, default=-1) + 1


def upsert(rows: DataFrame, path: str, version: int, writer: str, gather: Iterable[str] = ()) -> None:
    """Write the rows of one version; writing it again replaces its folder, so a retried batch changes nothing.

    `gather`: columns whose rows are put together first, as a micro-batch has few rows in
    many partitions, which would each leave a file.
    """
    gathered = rows.repartition(*gather) if gather else rows
    gathered.write.mode("overwrite").parquet(f"{path.rstrip('/')}/writer={writer}/version={version}")


def _deltas(spark: SparkSession, folder: Folder, layout: Layout, snapshot: Snapshot, ended: bool = False) -> tuple[DataFrame | None, dict[str, int]]:
    """Rows of the versions above a snapshot with their order, and the newest version of each writer among them."""
    open_versions = {}
    for writer, numbers in _versions(folder).items():
        above = [n for n in numbers if n > snapshot.folded.get(writer, -1)]
        if ended:  # what is being written stays for the next compaction, with all above it
            done = []
            for n in above:
                if not folder.holds(f"writer={writer}/version={n}/_SUCCESS"):
                    break
                done.append(n)
            above = done
        if above:
            open_versions[writer] = above
    if not open_versions:
        return None, {}
    schema = StructType([*layout.schema.fields, StructField("writer", StringType()), StructField("version", LongType())])
    paths = [f"{folder.path}/writer={w}/version={n}" for w, numbers in open_versions.items() for n in numbers]
    rows = spark.read.schema(schema).option("basePath", folder.path).parquet(*paths)
    # a seed takes the version above all others, which may be the running stream's next
    # one; that batch comes later, so at equal versions the stream's row counts
    order = 2 * F.col("version") + (F.col("writer") == STREAM).cast("long")
    return rows.select(*layout.schema.fieldNames(), order.alias("_order")), {w: n[-1] for w, n in open_versions.items()}


def _base(spark: SparkSession, folder: Folder, layout: Layout, snapshot: Snapshot, buckets: Iterable[str] | None = None) -> DataFrame | None:
    wanted = snapshot.buckets if buckets is None else {b: snapshot.buckets[b] for b in buckets if b in snapshot.buckets}
    if not wanted:
        return None
    schema = StructType([*layout.schema.fields, StructField("_order", LongType())])
    return spark.read.schema(schema).parquet(*[f"{folder.path}/_base/{at}/bucket={b}" for b, at in sorted(wanted.items())])


def _newest_rows(layout: Layout, *parts: DataFrame | None) -> DataFrame | None:
    held = [p for p in parts if p is not None]
    if not held:
        return None
    rows = held[0] if len(held) == 1 else held[0].unionByName(held[1])
    newest = [F.max_by(c, "_order").alias(c) for c in layout.values]
    return rows.groupBy(*layout.key).agg(*newest, F.max("_order").alias("_order"))


def read_current(spark: SparkSession, path: str, layout: Layout, buckets: Iterable[str] | None = None) -> DataFrame:
    """The newest version of every key; a hash aggregation with map-side combine.

    `buckets` names those whose rows are wanted; the others' files are not read.
    """
    folder = Folder(spark, path)
    snapshot = _newest(folder)
    deltas, _ = _deltas(spark, folder, layout, snapshot)
    if buckets is not None:
        buckets = list(buckets)
        deltas = deltas if deltas is None else deltas.where(layout.bucket().isin(buckets))
    rows = _newest_rows(layout, _base(spark, folder, layout, snapshot, buckets), deltas)
    if rows is None:
        return spark.createDataFrame([], layout.schema)
    return rows.select(*layout.schema.fieldNames())


def compact(spark: SparkSession, path: str, layout: Layout) -> bool:
    """Fold the finished versions into the buckets they touch and publish the snapshot.

    Only buckets with new rows are rewritten; their number is bounded by the calendar, not by the rows. False if
    there is nothing to fold or another compaction was faster.
    """
    folder = Folder(spark, path)
    snapshot = _newest(folder)
    deltas, newest = _deltas(spark, folder, layout, snapshot, ended=True)
    if deltas is None:
        return False
    touched = [r[0] for r in deltas.select(layout.bucket().alias("bucket")).distinct().collect()]
    merged = _newest_rows(layout, _base(spark, folder, layout, snapshot, touched), deltas)
    name = f"{snapshot.number + 1:012d}-{uuid.uuid4().hex[:8]}"
    bucketed = merged.withColumn("bucket", layout.bucket())
    bucketed.repartition("bucket").write.mode("errorifexists").partitionBy("bucket").parquet(f"{folder.path}/_base/{name}")
    held = {"folded": {**snapshot.folded, **newest}, "buckets": {**snapshot.buckets, **{b: name for b in touched}}}
    if not folder.create(f"_current/{snapshot.number + 1:012d}", json.dumps(held)):
        folder.delete(f"_base/{name}")
        return False
    _vacuum(folder)
    return True


def _vacuum(folder: Folder) -> None:
    """Delete what none of the newest snapshots needs."""
    kept = _snapshots(folder)[-KEEP:]
    if kept[-1].number < KEEP:
        return
    for name in folder.names("_current"):
        if name.isdigit() and int(name) < kept[0].number:
            folder.delete(f"_current/{name}")
    named = {at for snapshot in kept for at in snapshot.buckets.values()}
    for name in folder.names("_base"):
        # a folder above the newest snapshot belongs to a compaction that is still going on
        if name not in named and int(name.split("-")[0]) <= kept[-1].number:
            folder.delete(f"_base/{name}")
    for writer, numbers in _versions(folder).items():
        for n in numbers:
            if n <= kept[0].folded.get(writer, -1):
                folder.delete(f"writer={writer}/version={n}")
