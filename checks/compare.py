"""Run queries and oracle side by side and report where they differ.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

VIEWS = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in VIEWS:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types and the multiset of rows agree."""
    answer = con.sql(sql)
    spark_types = {f.name: f.dataType.simpleString() for f in result.schema}
    duck_types = {n: _simple(str(t)) for n, t in zip(answer.columns, answer.types)}
    if spark_types != duck_types:
        return [f"schema: {sorted(set(spark_types.items()) ^ set(duck_types.items()))}"]
    ours = _rows(result.columns, [tuple(r) for r in result.collect()])
    theirs = _rows(answer.columns, answer.fetchall())
    return [f"only spark: {r}" for r in (ours - theirs)][:3] + [
        f"only oracle: {r}" for r in (theirs - ours)
    ][:3]


# Names of the same type in both engines.
_TYPE_NAMES = {
    "varchar": "string",
    "integer": "int",
    "bigint": "bigint",
    "timestamp": "timestamp_ntz",
}


def _simple(duck_type: str) -> str:
    lowered = duck_type.lower()
    return _TYPE_NAMES.get(lowered, lowered)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    for name in names:
        start = time.time()
        try:
            found = differences(QUERIES[name](spark, sf_dir), con, ORACLE[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("    ", line)


if __name__ == "__main__":
    main()
