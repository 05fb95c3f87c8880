"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Half-up rounding that does not depend on the order of a float sum.

    A mean of cent prices often lands on an exact half; the last bit of the sum
    would decide. Going through a decimal of ten places drops that noise first.
    """
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def mean_2dp(value: Column) -> Column:
    """The mean, rounded to two decimals, as every published series has it."""
    return round_half_up(F.avg(value), 2)
