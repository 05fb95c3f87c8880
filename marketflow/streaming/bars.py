"""Bars on a stream, and scores of a stream with models that change while it runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from marketflow.functions import bucket_start, format_date
from marketflow.operators.bars import bars
from marketflow.operators.models import FEATURES, score
from marketflow.sinks import keyed
from marketflow.streaming.live import COMPACT_EVERY, triggered

#: bars by ticker and start; those of one month share a bucket
BARS = keyed.Layout(
    StructType(
        [
            StructField("tickerSymbol", StringType()),
            StructField("timestamp", LongType()),
            StructField("open", DoubleType()),
            StructField("high", DoubleType()),
            StructField("low", DoubleType()),
            StructField("close", DoubleType()),
            StructField("volume", LongType()),
            StructField("vw", DoubleType()),
            StructField("numberOfItems", LongType()),
        ]
    ),
    ("tickerSymbol", "timestamp"),
    lambda: F.coalesce(F.substring(format_date(F.col("timestamp")), 1, 7), F.lit("none")),
)
#: the coefficients of each sector; one bucket
MODELS = keyed.Layout(
    StructType(
        [StructField("sector", StringType()), StructField("intercept", DoubleType())]
        + [StructField(f"coef_{feature}", DoubleType()) for feature in FEATURES]
    ),
    ("sector",),
    lambda: F.lit("all"),
)


def stream_bars(ticks: DataFrame, multiplier: int = 15, unit: str = "minute", delay: str = "2 days") -> DataFrame:
    """Bars of a stream of ticks, in update mode: a bar comes out again whenever a tick joins it.

    First and last price are kept with their order in the state of the aggregation, like
    sums and extremes, so ticks may come in any order over any number of micro-batches. State
    holds one row per bar until the watermark passes the bar's start by the delay.
    """
    start = F.timestamp_millis(bucket_start(F.col("timestamp"), multiplier, unit))
    timed = ticks.withColumn("bar_time", start).withWatermark("bar_time", delay)
    return bars(timed, multiplier, unit, ("tickerSymbol", "bar_time")).select(*BARS.schema.fieldNames())


def upsert_bars(
    frame: DataFrame, path: str, checkpoint: str, every: str | None = None, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Keep a table of bars current; `read_live_bars` reads it while the stream goes on."""
    first = keyed.next_version(frame.sparkSession, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed.upsert(batch, path, first + batch_id, keyed.STREAM)
        if (batch_id + 1) % compact_every == 0:
            keyed.compact(batch.sparkSession, path, BARS)

    writer = frame.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return triggered(writer.foreachBatch(write), every).start()


def read_live_bars(spark: SparkSession, path: str) -> DataFrame:
    """Every bar as it is now."""
    return keyed.read_current(spark, path, BARS)


def publish_models(coefficients: DataFrame, path: str) -> None:
    """Put the coefficients of some sectors into the table of models that running streams score with."""
    spark = coefficients.sparkSession
    keyed.upsert(coefficients.select(*MODELS.schema.fieldNames()), path, keyed.next_version(spark, path), keyed.BATCH)
    keyed.compact(spark, path, MODELS)


def score_stream(frame: DataFrame, models: str, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Score a stream of bars with the models that are published when a micro-batch runs.

    The table of models is read anew for each batch, so a new model counts from the next
    batch on. A batch goes to a folder of its own; one that is repeated replaces it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        coefficients = keyed.read_current(batch.sparkSession, models, MODELS)
        score(batch, coefficients).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = frame.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return triggered(writer, every).start()
