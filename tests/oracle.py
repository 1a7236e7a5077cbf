"""Compare registered queries with their SQL on DuckDB.

As a script: ``python tests/oracle.py [sf] [query ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    def norm(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(float(v), 6) if isinstance(v, (float, int)) and not isinstance(v, bool) else v

    columns = sorted(frame.columns)
    values = [[norm(v) for v in frame[c].astype(object).tolist()] for c in columns]
    return sorted(zip(*values), key=repr)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    kinds = {
        c: (spark_frame[c].dtype.kind, sql_frame[c].dtype.kind)
        for c in spark_frame
        if spark_frame[c].dtype.kind != sql_frame[c].dtype.kind
    }
    a, b = rows(spark_frame), rows(sql_frame)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows, first {str(wrong[0])[:600]}"
    return f"kinds {kinds}" if kinds and len(a) else None


def main() -> None:
    import __spark_entry__ as entry

    from textprep.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    wanted = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "oracle",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions="8",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    for name in wanted:
        start = time.time()
        try:
            got = entry.queries()[name](spark, sf_dir).toPandas()
            took = time.time() - start
            verdict = difference(got, con.execute(sql[name]).df()) if name in sql else f"no SQL, {len(got)} rows"
        except Exception as error:  # noqa: BLE001  report and go on
            took, verdict = time.time() - start, f"ERROR {str(error)[:1500]}"
        print(f"{name:30s} {took:6.2f}s  {'ok' if verdict is None else verdict}", flush=True)


if __name__ == "__main__":
    main()
