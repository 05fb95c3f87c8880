"""Live sources: a message broker or files that appear in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketflow.schema import BAR_SCHEMA, SECTORS


def broker_options(servers: str, topics=SECTORS, starting: str = "earliest") -> dict[str, str]:
    """Options that subscribe one query to all topics."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }


def open_records(spark: SparkSession, kind: str = "kafka", **options: str) -> DataFrame:
    """A stream of `value` and `topic`, and `delivery` if the source numbers its records.

    The broker's connector is needed only here. Records of one key are in one partition,
    so their offsets tell which delivery of a bar is the last.
    """
    reader = spark.readStream.format(kind)
    for key, value in options.items():
        reader = reader.option(key, value)
    loaded = reader.load()
    return loaded.select("value", "topic", *[F.col(c).alias("delivery") for c in loaded.columns if c == "offset"])


def follow_bars(
    spark: SparkSession, path: str, schema: StructType = BAR_SCHEMA, max_files: int | None = None
) -> DataFrame:
    """New bar files under `path`, from the first one on.

    The position is kept in the query's checkpoint. A file is read once, whole:
    writers must put finished files in place. `max_files` paces the intake.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def follow_sector_tree(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """New bar files of `{root}/{sector}/{ticker}.txt`, as records of topic = sector."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(f"{root.rstrip('/')}/*/*.txt")
    topic = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    return lines.select(F.col("value"), topic.alias("topic"))


def follow_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder as a stream; the table is a file or a folder of part files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    # a stream starts from folders; a pattern also matches a single file
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")
