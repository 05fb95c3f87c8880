"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.operators.bars import to_wire
from marketflow.operators.records import pretty_json
from marketflow.operators.series import assign_sectors


def land_bars(frame: DataFrame, dimension: DataFrame, path: str, rejects: str | None = None, rows_per_file: int = 1_000_000) -> None:
    """Write bars as JSON lines under `sector=/tickerSymbol=`, replacing those tickers.

    Only the folders of the tickers at hand are overwritten. AQE gathers the bars of a
    ticker in one file and splits those of a hot one by their size; no file exceeds
    `rows_per_file`. Bars without sector, ticker or time are appended to `rejects`
    (`{path}-rejects`), as they are.
    """
    known, unknown = assign_sectors(frame, dimension)
    (
        to_wire(known, "sector")
        .hint("rebalance", "sector", "tickerSymbol")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("sector", "tickerSymbol")
        .json(path)
    )
    unknown.write.mode("append").json(rejects or f"{path.rstrip('/')}-rejects")


def write_results(series: DataFrame, path: str) -> None:
    """Write published series as JSON lines, one folder per sector and scope.

    A series is one row per timestamp, so a folder is bounded by the calendar.
    """
    (
        series.repartition("sector", "scope")
        .sortWithinPartitions("sector", "scope", "timestamp")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("sector", "scope")
        .json(path)
    )


def write_pretty_json(frame: DataFrame, path: str) -> None:
    """Write every row as one indented JSON document in a text file of its own.

    For side documents: few rows, one file each.
    """
    pretty_json(frame).write.mode("errorifexists").option("maxRecordsPerFile", 1).text(path)


def show(frame: DataFrame, rows: int = 20) -> None:
    """Print the first rows."""
    frame.show(rows, truncate=False)
