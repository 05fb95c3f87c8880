"""Run registered queries next to their DuckDB twins and compare every value.

`python -m tests.compare [folder] [name ...]` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def ordered(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def difference(frame, relation) -> str | None:
    """None if both hold the same rows, else what differs."""
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} != {sorted(relation.columns)}"
    ours = ordered([tuple(row) for row in frame.collect()], frame.columns)
    theirs = ordered(relation.fetchall(), relation.columns)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            return f"{a} != {b}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from marketflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    twins = oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.perf_counter()
        try:
            frame = query(spark, sf_dir)
            if name in twins:
                outcome = difference(frame, connection.sql(twins[name])) or f"equal, {len(frame.columns)} columns"
            else:
                outcome = f"no twin, {frame.count()} rows"
        except Exception as error:  # report and go on with the next query
            outcome = f"FAILED {type(error).__name__}: {' '.join(str(error).split())[:300]}"
        print(f"{name:32s} {time.perf_counter() - started:6.2f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main()
