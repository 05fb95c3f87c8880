"""Column expressions; all are built-in Spark functions."""

from marketflow.functions.numbers import mean_2dp, round_half_up
from marketflow.functions.time import (
    bucket_start,
    epoch_ms,
    format_date,
    format_instant,
    lookback_start,
    next_business_day,
    weekday,
)

__all__ = [
    "bucket_start",
    "epoch_ms",
    "format_date",
    "format_instant",
    "lookback_start",
    "mean_2dp",
    "next_business_day",
    "round_half_up",
    "weekday",
]
