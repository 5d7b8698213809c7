"""Run queries and their SQL side by side: rows, columns, types and values."""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

ROOT = Path(__file__).resolve().parent.parent


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 8")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.10g}")
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "array<string>": "VARCHAR[]",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and its SQL; empty when nothing does."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = _rows(names, cursor.fetchall())
    actual = _rows(df.columns, df.collect())
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for name, kind in df.dtypes:
        if SPARK_TYPES.get(kind) != types[name]:
            found.append(f"type of {name}: {kind} against {types[name]}")
    if sum(actual.values()) != sum(expected.values()):
        found.append(f"{sum(actual.values())} rows against {sum(expected.values())}")
    if actual != expected:
        found.append(f"only Spark {list((actual - expected).items())[:2]}, "
                     f"only SQL {list((expected - actual).items())[:2]}")
    return found


def main(sf_dir: str, keys: list[str]) -> int:
    sys.path.insert(0, str(ROOT))
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from demandlens.session import spark_session

    spark = spark_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="14g", spark__driver__maxResultSize="6g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = views(sf_dir), 0
    for key in keys or QUERIES:
        start = time.time()
        try:
            found = differences(QUERIES[key](spark, sf_dir), con, ORACLE[key])
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{key:26s} {time.time() - start:6.2f}s {'ok' if not found else found}", flush=True)
    print(f"{bad} queries differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
