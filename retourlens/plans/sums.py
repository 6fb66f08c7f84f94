"""What features are fitted on and planned by: counts and sums of the rows.

One pass sums by what has few values, brands and prices, and measures the rest:
rows by hash bucket of user and item, and the number of items. Groups as many as
the catalogue or the users are summed only where they are needed, in small
catalogues and in buckets that may hold a busy key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retourlens.session import scratch_path, settle

#: What rows are summed by in the first pass, each with its own keys.
SETS = {"brand": ["brand_id"], "price": ["__by_price"], "user": ["__user"], "item": ["__item"], "sample": ["__sampled"]}
#: What rows of small catalogues are summed by.
ITEM_SETS = {"size": ["item_id", "item_size"], "colour": ["item_id", "item_color"]}
VALUES = ["__known", "__returns", "__rows", "__price", "__prices"]
# Hash buckets of users and of items; null has bucket -1. One item in so many is counted for an estimate.
BUCKETS, SAMPLED = 4096, 64


def _set_name(sets: dict[str, list[str]], keys: list[str]) -> Column:
    """Which of ``sets`` a row of the result is of; a key that is grouped by has no grouping mark."""
    name = F.lit(None).cast("string")
    for own, columns in reversed(sets.items()):
        grouped = F.lit(True)
        for key in keys:
            grouped = grouped & (F.grouping(key) == (0 if key in columns else 1))
        name = F.when(grouped, own).otherwise(name)
    return name


def _bucket(key: str, buckets: int = BUCKETS) -> Column:
    return F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _grouped(rows: DataFrame, sets: dict[str, list[str]]) -> DataFrame:
    """One row for each group of each of ``sets``, named by ``set``; rows are scanned once, and combined before they move."""
    keys = list(dict.fromkeys(k for columns in sets.values() for k in columns))
    label = F.when(~F.col("is_unknown"), F.col("returned"))
    return rows.groupingSets([[F.col(k) for k in columns] for columns in sets.values()], *keys).agg(
        _set_name(sets, keys).alias("set"), F.count(label).alias("__known"), F.sum(label).alias("__returns"), F.count("*").alias("__rows"),
        F.sum("item_price").alias("__price"), F.count("item_price").alias("__prices"),
    )


def summed(rows: DataFrame, max_group_rows: int) -> DataFrame:
    """Groups of ``SETS``; of buckets those that may hold a key with more than ``max_group_rows`` rows."""
    sampled = F.pmod(F.xxhash64(F.lit(1), "item_id"), F.lit(SAMPLED)) == 0
    prepared = rows.withColumns(
        {"__by_price": F.col("item_price"), "__user": _bucket("user_id"), "__item": _bucket("item_id"), "__sampled": F.when(sampled, F.col("item_id"))}
    )
    crowded = F.col("__rows") > max_group_rows
    usable = {
        "brand": F.col("brand_id").isNotNull(), "price": F.col("__by_price").isNotNull(), "user": crowded, "item": crowded,
        "sample": F.col("__sampled").isNotNull(),
    }
    wanted = F.lit(False)
    for name, condition in usable.items():
        wanted = wanted | ((F.col("set") == name) & condition)
    return _grouped(prepared, SETS).where(wanted)


def _stored(sums: DataFrame, sets: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Each set as a partition of one stored table, so Spark knows its own size."""
    path = scratch_path(sums.sparkSession, "sums")
    sums.write.partitionBy("set").parquet(path)
    stored = sums.sparkSession.read.schema(sums.schema).parquet(path)
    return {name: stored.where(F.col("set") == name).select(*columns, *VALUES) for name, columns in sets.items()}


@dataclass(frozen=True)
class Sums:
    """``brand`` and ``price`` are summed; ``hot_users`` and ``hot_items`` are the
    keys, null among them, with more than ``max_group_rows`` rows; ``items`` is
    about how many items there are."""

    rows: DataFrame
    brand: DataFrame
    price: DataFrame
    hot_users: DataFrame
    hot_items: DataFrame
    items: int

    def catalogue(self) -> tuple[DataFrame, DataFrame]:
        """Sums of sizes and of colours of each item, in one more pass. Rows
        without an item are left out; sizes and colours may be null."""
        tables = _stored(_grouped(self.rows.where(F.col("item_id").isNotNull()), ITEM_SETS), ITEM_SETS)
        return tables["size"], tables["colour"]


def _hot(rows: DataFrame, key: str, buckets: Sequence[int], max_group_rows: int) -> DataFrame:
    """Keys in ``buckets`` with more than ``max_group_rows`` rows; without buckets nothing is read."""
    if not buckets:
        return rows.sparkSession.createDataFrame([], rows.select(key).schema)
    near = rows.select(key) if len(buckets) > BUCKETS // 2 else rows.select(key).where(_bucket(key).isin(*buckets))
    counts = near.groupBy(key).agg(F.count("*").alias("rows"))
    return settle(counts.where(F.col("rows") > max_group_rows).select(key), f"hot-{key}")


def group_sums(rows: DataFrame, max_group_rows: int) -> Sums:
    """All that is known of prepared rows before features are built.

    Expects rounded prices, normalised size texts and corrected colours. No key
    has more rows than its bucket, so keys are counted in crowded buckets only.
    """
    first = _stored(summed(rows, max_group_rows), SETS)
    crowded = first["user"].select(F.lit("user").alias("of"), F.col("__user").alias("bucket")).union(
        first["item"].select(F.lit("item").alias("of"), F.col("__item").alias("bucket"))
    )
    found = crowded.collect()
    user, item = ([r["bucket"] for r in found if r["of"] == of] for of in ("user", "item"))
    return Sums(
        rows,
        first["brand"],
        first["price"].withColumnRenamed("__by_price", "item_price"),
        _hot(rows, "user_id", user, max_group_rows),
        _hot(rows, "item_id", item, max_group_rows),
        SAMPLED * first["sample"].count(),
    )
