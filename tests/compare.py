"""Run registered queries in Spark and in DuckDB and compare the results.

``python tests/compare.py SF_DIR [NAME ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("documents", "conversations", "pages", "benchmark")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    table = df.select(*columns).toArrow()
    return columns, sorted(zip(*(table.column(c).to_pylist() for c in columns), strict=True))


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.sql(sql).to_arrow_table()
    columns = sorted(result.column_names)
    return columns, sorted(zip(*(result.column(c).to_pylist() for c in columns), strict=True))


def main(sf_dir: str, names: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from tokenloom.session import local_session

    spark, con = local_session(8), connect(sf_dir)
    oracles = oracle_sql()
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        if name not in oracles:
            continue
        ours = spark_rows(query(spark, sf_dir))
        middle = time.time()
        theirs = duck_rows(con, oracles[name])
        verdict = "ok" if ours == theirs else "DIFFERENT"
        print(f"{verdict:9} {name:30} {len(ours[1]):8} rows  spark {middle - start:6.2f}s  duckdb {time.time() - middle:6.2f}s", flush=True)
        if ours != theirs:
            print("  columns", ours[0], theirs[0], "rows", len(ours[1]), len(theirs[1]))
            print("  only spark ", sorted(set(ours[1]) - set(theirs[1]))[:5])
            print("  only duckdb", sorted(set(theirs[1]) - set(ours[1]))[:5])


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
