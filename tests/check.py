"""Run the registered queries and their SQL side by side.

    python tests/check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value + 0.0:.9f}"
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty when equal, else what differs."""
    df = queries()[name](spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    result = con.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} of {len(mine)} rows differ, first {bad[0]}" if bad else ""


if __name__ == "__main__":
    from conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    session, connection = make_session(), connect(sf)
    for name in names:
        start = time.time()
        try:
            problem = compare(session, connection, name, sf)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:26s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
