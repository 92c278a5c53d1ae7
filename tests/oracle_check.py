"""Run queries and their SQL side by side: python tests/oracle_check.py [sf] [names]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.6f}"
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted(tuple(_cell(row[i]) for i in order) for row in rows))


def differences(df, con, sql) -> list[str]:
    """What differs between a DataFrame and a statement; empty if nothing."""
    columns, rows = table_of(df.columns, df.collect())
    result = con.execute(sql)
    want_columns, want = table_of([d[0] for d in result.description], result.fetchall())
    if columns != want_columns:
        return [f"columns {columns} want {want_columns}"]
    if len(rows) != len(want):
        return [f"rows {len(rows)} want {len(want)}"]
    bad = [(a, b) for a, b in zip(rows, want) if a != b]
    return [f"{len(bad)} of {len(rows)} rows, first {bad[0]}"] if bad else []


def main():
    import __spark_entry__ as contract
    from fieldbalance.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = contract.queries(), contract.oracle_sql()
    names = sys.argv[2:] or list(queries)
    con = duck(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            found = differences(queries[name](spark, sf_dir), con, oracle[name])
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{name:26s} {time.time() - start:6.2f}s {'ok' if not found else found}", flush=True)
    print("failed:", failed, "of", len(names))


if __name__ == "__main__":
    main()
