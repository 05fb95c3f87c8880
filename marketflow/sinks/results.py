"""The result store: published rows by sector, scope and timestamp, upserted and compacted.

A daily seed and a running stream are writers of their own, so neither replaces a
folder of the other; `keyed` tells how versions and snapshots work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.operators.ranking import document_ids
from marketflow.schema import RESULT_SCHEMA
from marketflow.sinks import keyed
from marketflow.sinks.keyed import BATCH, STREAM, next_version

KEY = ("sector", "scope", "timestamp")
VALUES = ("avg_close", "avg_prediction")
#: rows of one month share a bucket
LAYOUT = keyed.Layout(RESULT_SCHEMA, KEY, lambda: F.when(F.col("timestamp").rlike(r"^\d{4}-\d{2}"), F.substring("timestamp", 1, 7)).otherwise("none"))

__all__ = ["BATCH", "STREAM", "compact", "index_documents", "next_version", "read_current", "upsert"]


def upsert(series: DataFrame, path: str, version: int, writer: str = BATCH) -> None:
    """Write the rows of one version of a writer; `series` has the result schema."""
    keyed.upsert(series, path, version, writer, gather=("sector", "scope"))


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of every key."""
    return keyed.read_current(spark, path, LAYOUT)


def compact(spark: SparkSession, path: str) -> bool:
    """Fold the versions written so far; readers go on meanwhile."""
    return keyed.compact(spark, path, LAYOUT)


def index_documents(series: DataFrame, client_factory) -> None:
    """Send rows to a document index through a client the caller provides.

    `client_factory()` runs once per partition and returns an object with
    `index(index=..., id=..., document=...)`. Ids are positions in the series,
    so a second run overwrites instead of appending.
    """
    documents = document_ids(series).select(
        "index", "id", F.to_json(F.struct("timestamp", *VALUES)).alias("document")
    )

    def send(rows) -> None:
        client = client_factory()
        for row in rows:
            client.index(index=row["index"], id=row["id"], document=row["document"])

    documents.foreachPartition(send)
