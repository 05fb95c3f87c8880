"""Records: parsing, serializing, routing by topic, counting words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketflow.schema import BAR_SCHEMA


def parse_records(records: DataFrame, schema: StructType = BAR_SCHEMA) -> DataFrame:
    """`data` struct and `topic` from broker records; bad text parses to nulls."""
    return records.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"), F.col("topic").cast("string")
    )


def split_malformed(
    records: DataFrame, schema: StructType = BAR_SCHEMA, latest_ms: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Parsed records, and the raw ones that carry no timestamp, or one after `latest_ms`.

    A single bar dated far ahead would carry a watermark past all that is still to come.
    A `delivery` column stays beside the parsed records.
    """
    parsed = records.withColumn("data", F.from_json(F.col("value").cast("string"), schema))
    bad = F.col("data.timestamp").isNull()
    if latest_ms is not None:
        bad = bad | (F.col("data.timestamp") > latest_ms)
    topic = F.col("topic").cast("string").alias("topic")
    return (
        parsed.filter(~bad).select("data", topic, *[c for c in records.columns if c == "delivery"]),
        parsed.filter(bad).select(F.col("value").cast("string").alias("value"), topic),
    )


def with_unknown(records: DataFrame, schema: StructType = BAR_SCHEMA, value: str = "value") -> DataFrame:
    """`data` struct, and the top-level fields that `schema` lacks as variants by name in `unknown`.

    Fields that a feed adds, or sends in a new shape, are kept as they came, numbers as
    numbers and records as records. Text that is no JSON object has neither; other columns stay.
    """
    text = F.col(value).cast("string")
    # records that are no object, or name a field twice, parse to null
    fields = F.from_json(text, "map<string, variant>")
    unknown = F.map_filter(fields, lambda name, _: ~name.isin(schema.fieldNames()))
    kept = [c for c in records.columns if c not in (value, "data", "unknown")]
    return records.select(*kept, F.from_json(text, schema).alias("data"), unknown.alias("unknown"))


def unknown_field(name: str) -> Column:
    """One of the `unknown` fields as a variant; null where the record lacks it."""
    return F.try_element_at("unknown", F.lit(name))


def to_records(frame: DataFrame, topic: str = "sector") -> DataFrame:
    """Rows as JSON messages with the topic they go to; one query feeds all topics."""
    body = [c for c in frame.columns if c != topic]
    return frame.select(F.col(topic).alias("topic"), F.to_json(F.struct(*body)).alias("value"))


def only_topic(records: DataFrame, topic: str) -> DataFrame:
    """The records of one topic, for an output of its own."""
    return records.filter(F.col("topic") == topic)


def record_key(frame: DataFrame, key: str) -> DataFrame:
    """Only the nested record `key`, as the message."""
    return frame.select(F.to_json(F.col(key)).alias("value"))


def pretty_json(frame: DataFrame) -> DataFrame:
    """Rows as indented JSON text."""
    return frame.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"))


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """Words split on single blanks, counted; empty words count as words."""
    words = lines.select(F.explode(F.split(F.col(text), " ", -1)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
