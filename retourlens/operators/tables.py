"""Set operations, projections and row reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How ids of the unlabelled file map onto the labelled one.
UNKNOWN_REKEY = {"item_id": (2, 2), "brand_id": (1, 100)}


def rekey(df: DataFrame, rules: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """``factor * id + offset`` for every listed id column."""
    rules = UNKNOWN_REKEY if rules is None else rules
    return df.withColumns({c: F.col(c) * a + b for c, (a, b) in rules.items()})


def stack_splits(known: DataFrame, unknown: DataFrame) -> DataFrame:
    """UNION ALL by name with ``is_unknown``; a missing column becomes null."""
    return known.withColumn("is_unknown", F.lit(False)).unionByName(
        unknown.withColumn("is_unknown", F.lit(True)), allowMissingColumns=True
    )


def split(df: DataFrame, label: str | None = "returned") -> tuple[DataFrame, DataFrame]:
    """Known and unknown rows; the unknown side loses the label."""
    known = df.where(~F.col("is_unknown")).drop("is_unknown")
    unknown = df.where(F.col("is_unknown")).drop("is_unknown", *([label] if label else []))
    return known, unknown


def drop(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def reorder(df: DataFrame, columns: Sequence[str] | None = None, last: str | None = None) -> DataFrame:
    """Columns in the given order, or as they are with ``last`` at the end."""
    if columns is None:
        columns = [c for c in df.columns if c != last] + ([last] if last else [])
    return df.select(*columns)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def count_flagged(df: DataFrame, column: str, name: str = "n_flagged") -> DataFrame:
    return df.agg(F.count_if(F.col(column) == 1).alias(name))


def best_rows(df: DataFrame, metric: str) -> DataFrame:
    """Every row at the maximum; ties are kept."""
    return df.where(F.col(metric) == df.select(F.max(metric)).scalar())


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in an order that is spelled out."""
    return df.orderBy(*order).limit(n)
