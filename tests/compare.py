"""Run registered queries next to their SQL twins: ``python tests/compare.py DIR [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(repr, r)))


def compare(spark, connection, sf_dir: str, run, sql: str | None) -> str:
    df = run(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    if sql is None:
        return f"rows {len(mine)}" if mine else "EMPTY"
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} {sorted(names)}"
    if mine != theirs:
        only = [r for r in mine if r not in theirs[:100000]][:2] if len(mine) < 20000 else []
        gone = [r for r in theirs if r not in mine[:100000]][:2] if len(theirs) < 20000 else []
        return f"DIFFERENT {len(mine)} {len(theirs)}\n   mine {only or mine[:2]}\n   sql {gone or theirs[:2]}"
    kinds = {type(a) for r in mine[:50] for a in r} ^ {type(a) for r in theirs[:50] for a in r}
    note = f" types {sorted(k.__name__ for k in kinds)}" if kinds else ""
    return f"ok {len(mine)}{note}" if mine else "EMPTY"


def main() -> None:
    import __spark_entry__ as entry
    from filingspark.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    twins = entry.oracle_sql()
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            verdict = compare(spark, connection, sf_dir, run, twins.get(name))
        except Exception as problem:
            verdict = "FAILED " + str(problem)[:600]
        print(f"{time.time() - began:6.1f}s {name}: {verdict}", flush=True)


if __name__ == "__main__":
    main()
