"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketflow.schema import BAR_SCHEMA, RESULT_SCHEMA


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited JSON bars under `path`, with the fixed schema.

    The schema is never inferred: inference costs a read of its own and takes a
    file that holds only whole prices for longs.
    """
    return spark.read.schema(BAR_SCHEMA).option("recursiveFileLookup", "true").json(path)


def read_sector_tree(spark: SparkSession, root: str) -> DataFrame:
    """Bars laid out as `{root}/{sector}/{ticker}.txt`, with `sector` added.

    The sector and, where a bar lacks it, the ticker come from the file's path.
    """
    path = F.col("_metadata.file_path")
    bars = spark.read.schema(BAR_SCHEMA).json(f"{root.rstrip('/')}/*/*.txt")
    return bars.select(
        F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("sector"),
        F.coalesce(
            F.col("tickerSymbol"), F.regexp_extract(path, r"([^/]+)\.txt$", 1)
        ).alias("tickerSymbol"),
        *[F.col(f.name) for f in BAR_SCHEMA if f.name != "tickerSymbol"],
    )


def read_landed_bars(spark: SparkSession, path: str) -> DataFrame:
    """Bars written by the landing job: `sector=` and `tickerSymbol=` folders.

    Both are partition columns, so a filter on them skips the files.
    """
    schema = StructType([*BAR_SCHEMA.fields, StructField("sector", StringType())])
    return spark.read.schema(schema).json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Published series (`sector=`/`scope=` folders), for seeding the live view."""
    return spark.read.schema(RESULT_SCHEMA).json(path)


def read_json_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Whole JSON documents, one per file and possibly pretty-printed."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)
