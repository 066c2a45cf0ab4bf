"""Runs registered queries and their SQL side by side and compares all rows.

    python tests/oracle_check.py <sf_dir> [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, con, sf_dir: str, query, sql: str) -> tuple[int, str | None]:
    """Number of Spark rows, and what differs (None if nothing)."""
    df = query(spark, sf_dir)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return len(mine), f"columns {sorted(df.columns)} against {sorted(names)}"
    if mine != theirs:
        only_mine = sorted(set(mine) - set(theirs))[:3]
        only_theirs = sorted(set(theirs) - set(mine))[:3]
        return len(mine), f"{len(mine)} against {len(theirs)} rows; {only_mine} / {only_theirs}"
    return len(mine), None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tallyforge.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    session = build_session(
        "oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    connection, oracles = connect(folder), oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name in oracles:
                count, wrong = difference(session, connection, folder, query, oracles[name])
                state = "ok" if wrong is None else "DIFFERS " + wrong
            else:
                count, state = len(query(session, folder).collect()), "rows only"
        except Exception as error:  # report and go on with the next query
            count, state = 0, f"FAILED {str(error)[:600]}"
        print(f"{name:34} {count:7} {time.time() - started:6.1f}s {state}", flush=True)
