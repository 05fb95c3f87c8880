"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: words are runs of bytes other than space, tab, line feed, vertical tab, form feed and return
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_SPLIT = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = str.maketrans(UPPER, UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[str]:
    """Lower-case (A-Z only) words of a text; none of a null."""
    return WORD.findall(text.translate(ASCII_LOWER)) if text else []


def ascii_lower(column: Column) -> Column:
    """`words`' lower case as an expression: only A to Z change."""
    return F.translate(column, UPPER, UPPER.lower())


def text_key(column: Column) -> Column:
    """A 16-byte key that stands for the whole text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(column, F.lit("")).cast("binary")))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo `folds`; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0).cast("long"))


def apart(docs: DataFrame, *used: str) -> DataFrame:
    """`docs` with every column but the `used` ones under a name that clashes with nothing; `toDF` takes the old names back."""
    return docs.toDF(*[c if c in used else f"kept_{i}" for i, c in enumerate(docs.columns)])


def release() -> None:
    """Give memory that this worker no longer uses back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def releasing(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`function` over batches, then `release`: workers live on, and the next stage runs beside what they hold."""

    def run(batches: Iterator) -> Iterator:
        yield from function(batches)
        release()

    return run


def is_small(df: DataFrame, max_rows: int) -> bool:
    """Whether a settled table has at most `max_rows` rows, so that it may be broadcast."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """`df` with a broadcast hint if its counted size allows it, else as it is (a shuffled join)."""
    return F.broadcast(df) if is_small(df, max_rows) else df
