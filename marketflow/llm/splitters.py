"""Sharding by sampled splitters: range-partition records into shards of near equal bytes.

The ranges come from a sample of keys drawn in proportion to the records' sizes; the
shards are cut at exact byte positions inside the ranges, so a sample only decides how
even the work is spread, never where a record goes.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.session import settle

SAMPLE_SEED = 17


def _below(boundaries: list[tuple], order: list[str], types: dict[str, str]) -> Column:
    """How many of the sorted boundaries are at most a record's key: a binary search as one expression.

    The boundaries travel as one JSON literal, which the optimizer folds into an array.
    """
    if not boundaries:
        return F.lit(0)
    item = ",".join(f"{name}:{types[name]}" for name in order)
    text = json.dumps([dict(zip(order, key)) for key in boundaries], default=str)
    sorted_keys = F.from_json(F.lit(text), f"array<struct<{item}>>")
    key = F.struct(*[F.col(name) for name in order])
    steps = F.expr(f"array({','.join(str(1 << s) for s in reversed(range(len(boundaries).bit_length())))})")
    return F.aggregate(
        steps,
        F.lit(0),
        lambda found, step: F.when(F.get(sorted_keys, found + step - 1) <= key, found + step).otherwise(found),
    )


def sampled_ranges(
    records: DataFrame,
    order: list[str],
    size: str,
    ranges: int,
    per_range: int = 16,
    rounds: int = 3,
) -> Column:
    """The range of each record: an expression over the columns in `order`.

    About `ranges * per_range` keys are drawn, each record with a probability in
    proportion to its size; every `per_range`-th key of the sorted sample is a
    boundary. A range that then holds over twice its share of bytes and more than one
    record is overfull: it gets boundaries from a new sample of its own, for up to
    `rounds` rounds. Only the sample and one row per range come to the driver, both
    bounded by the parameters.
    """
    types = dict(records.dtypes)
    total = records.agg(F.sum(size)).first()[0] or 0
    if not total:
        return F.lit(0)

    def draw(rows: DataFrame, expected: Column | float, seed: int) -> list:
        share = F.col(size) * F.lit(1.0) / F.lit(float(total)) * expected
        return rows.where(F.rand(seed) < share).select(*order).orderBy(*order).collect()

    sample = draw(records, float(ranges * per_range), SAMPLE_SEED)
    chosen = sorted_unique([tuple(row) for row in sample[per_range::per_range]])
    share = total / ranges
    for turn in range(rounds):
        ranged = records.withColumn("__range", _below(chosen, order, types))
        full = ranged.groupBy("__range").agg(F.sum(size).alias("b"), F.count("*").alias("n"))
        overfull = full.where((F.col("b") > 2 * share) & (F.col("n") > 1)).orderBy("__range").collect()
        if not overfull:
            break
        # a range of m shares gets about 4 m sampled keys, of which every second one cuts
        mine = ranged.where(F.col("__range").isin([r["__range"] for r in overfull]))
        more = draw(mine, float(ranges * 4), SAMPLE_SEED + 1 + turn)
        chosen = sorted_unique(chosen + [tuple(row) for row in more[1::2]])
    return _below(chosen, order, types)


def sorted_unique(keys: list[tuple]) -> list[tuple]:
    """Keys in Spark's order (nulls first), each once."""
    return sorted(set(keys), key=lambda key: tuple((v is not None, v) for v in key))


def _longs(values: list[int]) -> Column:
    """An array literal."""
    return F.expr(f"array({','.join(f'{v}L' for v in values)})")


def shard_by_bytes(
    records: DataFrame,
    key: str,
    size: str,
    shards: int = 16,
    ranges_per_shard: int = 64,
) -> DataFrame:
    """`records` with `shard` (0 to `shards` - 1) and `slot` (gapless from 0 in each shard).

    Law: in the order of `key` (nulls first; ties by a fixed number per row), a record
    whose predecessors hold b of all B bytes goes to shard floor(b * shards / B). So
    each shard is a range of keys, and shards differ by less than one record from
    B / shards. A hot key's rows are cut apart like any others.

    * `key` is a number, text, boolean, date or timestamp; `size` a positive long. `records` should be narrow; all columns pass through.
    * Windows run inside a range only; there are `shards * ranges_per_shard` ranges and
      more where keys are dense. Their frames stream, so memory doesn't bound a range.
    * Empty input gives an empty result. Fewer records than shards leave shards empty.
      A record larger than B / shards may leave the shards that it spans empty.
    * Columns named `__row`, `__range`, `__before`, `__rank` are reserved.
    """
    numbered = settle(records.withColumn("__row", F.monotonically_increasing_id()), "records")
    order = [key, "__row"]
    ranges = sampled_ranges(numbered, order, size, shards * ranges_per_shard)
    ranged = numbered.withColumn("__range", ranges)
    held = {
        r["__range"]: (r["b"], r["n"])
        for r in ranged.groupBy("__range").agg(F.sum(size).alias("b"), F.count("*").alias("n")).collect()
    }
    if not held:
        return records.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    bytes_before, rows_before, b, n = [], [], 0, 0
    for number in range(max(held) + 1):
        bytes_before.append(b)
        rows_before.append(n)
        more = held.get(number, (0, 0))
        b, n = b + more[0], n + more[1]

    inside = Window.partitionBy("__range").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    running = F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(size)
    offset = lambda values: F.get(_longs(values), F.col("__range"))
    placed = ranged.select(
        "*",
        (offset(bytes_before) + running).alias("__before"),
        (offset(rows_before) + F.row_number().over(inside) - 1).alias("__rank"),
    ).withColumn("shard", F.expr(f"cast((__before * {shards}L) div {b}L as int)"))
    placed = settle(placed, "placed")
    first = {r["shard"]: r["r"] for r in placed.groupBy("shard").agg(F.min("__rank").alias("r")).collect()}
    starts = F.get(_longs([first.get(s, 0) for s in range(shards)]), F.col("shard"))
    return placed.withColumn("slot", F.col("__rank") - starts).drop("__row", "__range", "__before", "__rank")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, `size` (UTF-8 bytes plus 1; null text: 1) and `text_crc32` (null: that of no bytes) per document."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Documents in the order of doc_id over shards of equal bytes; see `shard_by_bytes`."""
    return shard_by_bytes(sizes(docs), "doc_id", "size", shards)
