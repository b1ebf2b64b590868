"""Run named queries in Spark and their SQL twins in DuckDB, and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from brindle import registry
from brindle.plans import load_all
from brindle.sources.tables import NAMES


def connect(folder: str):
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or isinstance(value, (str, bool, int)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    raise TypeError(f"result values must be plain, got {type(value)}: {value!r}")


def _key(row):
    return tuple((v is None, str(v)) for v in row)


TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def spark_rows(df):
    names = sorted((f.name, TYPES[f.dataType.simpleString()]) for f in df.schema.fields)
    return names, sorted([tuple(_plain(r[n]) for n, _ in names) for r in df.collect()], key=_key)


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted((d[0], str(d[1])) for d in cursor.description)
    at = [columns.index(n) for n, _ in names]
    return names, sorted([tuple(_plain(r[i]) for i in at) for r in cursor.fetchall()], key=_key)


def differences(spark, con, name: str, folder: str) -> str | None:
    got_names, got = spark_rows(registry.QUERIES[name](spark, folder))
    if name not in registry.SQL:
        return None if got else "no rows"
    names, expected = sql_rows(con, registry.SQL[name])
    if names != got_names:
        return f"columns {got_names} != {names}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"{a} != {b}"
    if not got:
        return "no rows"
    return None


def main(folder: str, wanted: list[str]) -> int:
    from brindle.session import build, clear_scratch

    load_all()
    spark = build(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in wanted or list(registry.QUERIES):
        start = time.time()
        try:
            problem = differences(spark, con, name, folder)
        except Exception as e:  # keep going: the report lists every failure
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        clear_scratch(spark)
        failed += problem is not None
        kind = "sql" if name in registry.SQL else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind:4} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
