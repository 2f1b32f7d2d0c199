"""Run registered queries on Spark and their SQL on DuckDB, and compare all values.

    python tests/compare.py <sf dir> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str | date | datetime):
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def differences(con, spark, sf_dir: str, query, sql: str) -> list[str]:
    """What differs, exactly: no tolerance on doubles."""
    df = query(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows against {len(theirs)}"] + [
            str(x) for x in sorted(set(ours) ^ set(theirs), key=repr)[:4]
        ]
    different = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    return [f"{len(different)} of {len(ours)} rows: {a} against {b}" for a, b in different[:3]]


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from caseload.session import build_session

    sf_dir, *names = sys.argv[1:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        sql = oracle_sql().get(name)
        try:
            found = differences(con, spark, sf_dir, query, sql) if sql else ["no SQL"]
            n_rows = query(spark, sf_dir).count() if not found or not sql else "-"
        except Exception as error:
            found, n_rows = [f"{type(error).__name__}: {str(error)[:1500]}"], "-"
        print(f"{name:32} {'ok' if not found else 'DIFFERS'} rows={n_rows} {time.time() - start:.1f}s")
        for line in found:
            print("    " + line)


if __name__ == "__main__":
    main()
