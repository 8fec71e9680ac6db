"""Run registered queries next to their SQL: python -m checks.compare [sf_dir] [names...]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.queries import QUERIES, oracle_queries

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "timestamp": "TIMESTAMP"}


def spark_session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str:
    """'ok' or what differs."""
    df = QUERIES[name](spark, sf_dir)
    got_types = {c: TYPES.get(t, t.upper()) for c, t in df.dtypes}
    columns = sorted(df.columns)
    got = Counter(tuple(row) for row in df.select(*columns).collect())
    cursor = con.execute(oracle_queries()[name])
    want_types = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(want_types) != columns:
        return f"columns differ: {set(want_types) ^ set(columns)}"
    order = [list(want_types).index(c) for c in columns]
    want = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    typed = [f"{c} {got_types[c]}/{want_types[c]}" for c in columns if got_types[c] != want_types[c]]
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{sum(got.values())} rows/{sum(want.values())}\n  cols {columns}\n  got {extra}\n  want {missing} {typed}"
    return f"ok {sum(got.values())}" + (f" but types {typed}" if typed else "")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = spark_session(), duck(sf_dir)
    for name in names:
        started = time.time()
        try:
            result = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on to the next query
            result = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name}: {result} ({time.time() - started:.1f}s)", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
