"""Cycles of bars as files that a stream follows: staged, then published by renaming.

A cycle is written under `_staged`, which no reader looks at, and its files are then
moved into `{feed}/{sector}/`. A rename puts a whole file in place, so a stream never
sees half of one. A marker tells that a cycle is out; a cycle that broke off is written
again and fills in what is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.operators.bars import to_wire
from marketflow.sinks.keyed import Folder


def publish_cycle(frame: DataFrame, feed: str, cycle: str, files_per_sector: int = 1) -> bool:
    """Publish the bars of one cycle as `{feed}/{sector}/{cycle}-{k}.txt`; false if the cycle is out already.

    `frame` has the columns of bars and `sector`. The bars of a sector are dealt by
    ticker over `files_per_sector` files; the same bars give the same files again.
    """
    folder = Folder(frame.sparkSession, feed)
    if folder.holds(f"_published/{cycle}"):
        return False
    staged = f"_staged/{cycle}"
    lines = to_wire(frame, "sector").select("sector", F.to_json(F.struct(*to_wire(frame).columns)).alias("value"))
    part = F.pmod(F.xxhash64(F.get_json_object("value", "$.tickerSymbol")), F.lit(files_per_sector))
    (
        lines.withColumn("part", part)
        .repartition("sector", "part")
        .write.mode("overwrite")
        .partitionBy("sector", "part")
        .text(f"{feed.rstrip('/')}/{staged}")
    )
    for sector_folder in folder.names(staged):
        sector = sector_folder.removeprefix("sector=")
        if sector != sector_folder and sector != "__HIVE_DEFAULT_PARTITION__":
            folder.make(sector)
            for part_folder in folder.names(f"{staged}/{sector_folder}"):
                at = f"{staged}/{sector_folder}/{part_folder}"
                for k, name in enumerate(n for n in folder.names(at) if n.startswith("part-")):
                    target = f"{sector}/{cycle}-{part_folder.removeprefix('part=')}-{k}.txt"
                    if not folder.holds(target) and not folder.rename(f"{at}/{name}", target):
                        raise OSError(f"could not publish {feed}/{target}")
    folder.create(f"_published/{cycle}", "")
    folder.delete(staged)
    return True
