"""Run queries beside their SQL twins: ``python -m checks.compare [sf_dir] [name..]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import all_sql
from checks.queries import all_queries
from retourlens.session import build_session

TABLES = ["lineitem", "orders", "customer", "part"]
SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _sorted(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        if frame[column].dtype == object:
            frame[column] = frame[column].map(lambda v: None if pd.isna(v) else str(v)[:10])
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> list[str]:
    """What differs between a query and its SQL twin; empty when they agree."""
    df = all_queries()[name](spark, sf_dir)
    result = con.execute(all_sql()[name])
    types = {d[0]: str(d[1]) for d in result.description}
    found = []
    if set(df.columns) != set(types):
        return [f"columns {sorted(set(df.columns) ^ set(types))}"]
    for column, kind in df.dtypes:
        if SPARK_TYPES.get(kind) != types[column]:
            found.append(f"type of {column}: {kind} and {types[column]}")
    ours, theirs = _sorted(df.toPandas()), _sorted(result.df())
    if len(ours) != len(theirs):
        return [*found, f"rows {len(ours)} and {len(theirs)}"]
    for column in ours.columns:
        left, right = ours[column], theirs[column]
        unequal = ~((left == right) | (left.isna() & right.isna()))
        if unequal.any():
            at = unequal.idxmax()
            found.append(f"{column}: {unequal.sum()} rows, first {left[at]!r} and {right[at]!r}")
    return found


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "checks", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), all_sql(), 0
    for name, query in all_queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            if name in sql:
                found = differences(spark, con, sf_dir, name)
            else:
                found = [] if query(spark, sf_dir).count() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        kind = "sql" if name in sql else "rows"
        print(f"{'FAIL' if found else 'ok'} {name} [{kind}] {time.time() - start:.1f}s", *found, flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
