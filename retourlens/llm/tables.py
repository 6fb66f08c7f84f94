"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts, as a class for Java's, Python's and DuckDB's regular expressions.
SPACE = r"\x20\x09-\x0D"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(column: str) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_results(df: DataFrame, results: list[str]) -> DataFrame:
    """``df`` without columns of its own that an operator's results would clash with."""
    return df.drop(*[c for c in df.columns if c.lower() in {r.lower() for r in results}])


def table_bytes(df: DataFrame) -> int:
    """Size of a table read from files, as Spark's planner sees it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())


def give_back() -> None:
    """Return free memory of this process to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function whose worker does not keep what the task has freed.

    Workers outlive their tasks, and several wait beside those at work.
    """

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
