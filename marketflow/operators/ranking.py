"""Ranks, last-N rows and moving means per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.schema import DAY_MS
from marketflow.session import settle


def _newest_first(ts: str, ties) -> list[Column]:
    return [F.col(ts).desc(), *[F.col(c).desc() for c in ties]]


def last_n(
    frame: DataFrame, n: int, keys=("tickerSymbol",), ts: str = "timestamp", ties=(), salts: int = 16
) -> DataFrame:
    """The `n` newest rows of every key.

    Two exact rounds: the newest `n` of each salted part of a key, then the
    newest `n` of those. The filter sits right on the window, so Spark limits
    each group before both shuffles, and no task sorts a whole hot key. It does so
    up to `spark.sql.optimizer.windowGroupLimitThreshold` rows; for a larger `n`
    the salts alone spread a key, so give more of them.
    """
    columns = frame.columns
    salt = F.pmod(F.xxhash64(ts, *ties), F.lit(salts))
    order = _newest_first(ts, ties)

    def newest(rows: DataFrame, *by: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n)

    return newest(newest(frame.withColumn("_salt", salt), *keys, "_salt").drop("_rank"), *keys).select(
        *columns
    )


def last_n_strict(frame: DataFrame, window_size: int, **options) -> DataFrame:
    """Rows whose newest-first rank is below `window_size`: one fewer than it."""
    return last_n(frame, window_size - 1, **options)


def rank_newest(
    frame: DataFrame,
    keys=("tickerSymbol",),
    ts: str = "timestamp",
    ties=(),
    slice_ms: int = DAY_MS,
    name: str = "row_num",
) -> DataFrame:
    """`row_number` per key, newest first, over every row.

    A key is cut into time slices. A slice is ranked on its own and shifted by
    the number of rows in the newer slices, which comes from a count per slice:
    a hot key is spread over its slices instead of sorted by one task. Window and
    join share the hash of (key, slice), so the rows are shuffled once; should a
    slice still be too big, pass a narrower `slice_ms`.
    """
    # nulls get a value of their own, so that the join can be a plain equality
    key_text = {
        f"_key_{k}": F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in keys
    }
    slice_no = F.coalesce(F.floor(F.col(ts) / F.lit(slice_ms)), F.lit(-(2**62)))
    sliced = frame.withColumns({**key_text, "_slice": slice_no})
    newer = (
        Window.partitionBy(*key_text).orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        sliced.groupBy(*key_text, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*key_text, "_slice", F.coalesce(F.sum("_rows").over(newer), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*key_text, "_slice").orderBy(*_newest_first(ts, ties))
    return (
        sliced.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, [*key_text, "_slice"])
        .select(*frame.columns, (F.col("_inside") + F.col("_offset")).alias(name))
    )


def rank_by_ranges(
    frame: DataFrame, keys=("tickerSymbol",), ts: str = "timestamp", ties=(), name: str = "row_num"
) -> DataFrame:
    """The same rank as `rank_newest`, for keys with crowded slices.

    The rows are dealt by ranges of (key, time, ties), from samples, and sorted inside
    their range: a key with half of all rows, be they of one day or without a time, is
    spread over many ranges. A row's rank is its place among its key's rows of the range
    plus the key's rows in the ranges before. The placed rows are settled, so that the
    counts and the ranks are of one and the same division.
    """
    key_text = {
        f"_key_{k}": F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in keys
    }
    order = [*[F.col(k).asc() for k in key_text], *_newest_first(ts, ties)]
    ranges = frame.withColumns(key_text).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(ranges.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    before = Window.partitionBy(*key_text).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*key_text, "_range").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)) + 1 - F.col("_first"))
    return placed.join(offsets.drop("_rows", "_first"), [*key_text, "_range"]).select(
        *frame.columns, (F.col("_at") + F.col("_offset")).alias(name)
    )


def moving_mean(
    bar_frame: DataFrame,
    window_size: int,
    column: str = "close",
    keys=("tickerSymbol",),
    ts: str = "timestamp",
    name: str = "moving_mean",
) -> DataFrame:
    """Mean of the `window_size - 1` newest bars up to and including each bar.

    For bar frames, where (key, timestamp) is unique on a fixed grid: the rows of
    a key are bounded by the calendar, not by the volume of the ticks.
    """
    newest = Window.partitionBy(*keys).orderBy(ts).rowsBetween(-(window_size - 2), 0)
    return bar_frame.withColumn(name, F.avg(column).over(newest))


def latest(frame: DataFrame, rows: int = 20, ts: str = "timestamp", ties=()) -> DataFrame:
    """The newest rows of the whole frame, for display."""
    return frame.orderBy(*_newest_first(ts, ties)).limit(rows)


def document_ids(series: DataFrame) -> DataFrame:
    """Index name and position of every published row, as the index expects them.

    A series has one row per (sector, scope, timestamp): its length is bounded
    by the calendar.
    """
    position = F.row_number().over(Window.partitionBy("sector", "scope").orderBy("timestamp"))
    return series.withColumn("index", F.concat_ws("_", "sector", "scope")).withColumn("id", position - 1)
