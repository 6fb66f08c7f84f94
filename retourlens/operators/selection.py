"""Exact medians of groups of any size, by selection instead of collection.

Values become order-preserving 64-bit keys. The keys of a group are counted by
their first bits; of these buckets only the one that holds the middle row is
counted again, by its next bits, until a single value is left. A level moves at
most one row a bucket and task, and no task ever holds the values of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retourlens.operators.grouping import all_present
from retourlens.session import settle

#: Distinct values of a group above which its median is selected, and bits of a level.
SELECT_OVER, LEVEL_BITS = 100_000, 11


def order_key(value: Column) -> Column:
    """A long that is ordered as the double is; NaN comes last, both zeros are one."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def _large_groups(counted: DataFrame, keys: Sequence[str], over: int) -> DataFrame:
    sizes = counted.groupBy(*keys).agg(F.count("*").alias("__values"), F.sum("__n").alias("__rows"))
    return settle(sizes.where(F.col("__values") > over).select(*keys, "__rows"), "large-groups")


def _select(counted: DataFrame, keys: Sequence[str], large: DataFrame, bits: int) -> DataFrame:
    """``keys, __middle`` of the groups in ``large``: the mean of the two middle rows' values."""
    ranks = F.array((F.col("__rows") + 1).cast("long"), (F.col("__rows") + 2).cast("long"))
    # Rows number (n + 1) / 2 and (n + 2) / 2, rounded down.
    targets = large.select(*keys, F.posexplode(ranks).alias("__side", "__rank"))
    targets = targets.select(*keys, "__side", F.floor(F.col("__rank") / 2).cast("long").alias("__rank"), F.lit(0).cast("long").alias("__at"))
    rows = settle(counted.join(large.select(*keys), list(keys), "left_semi").withColumn("__key", order_key(F.col("__value"))), "select-rows")
    done, shift = None, 64
    by = [*keys, "__side"]
    below = Window.partitionBy(*by).orderBy("__bucket")
    while True:
        # The key's sign bit is flipped, so that unsigned shifts keep the order.
        bucket = lambda down: F.shiftrightunsigned(F.col("__key").bitwiseXOR(F.lit(-(1 << 63))), down)
        higher, shift = shift, max(0, shift - bits)
        met = rows.join(targets, list(keys))
        if higher < 64:
            met = met.where(bucket(higher) == F.col("__at"))
        counts = met.groupBy(*by, "__rank", bucket(shift).alias("__bucket")).agg(
            F.sum("__n").alias("__n"), F.min("__value").alias("__low"), F.max("__value").alias("__high")
        )
        running = counts.withColumn("__upto", F.sum("__n").over(below))
        held = (F.col("__upto") >= F.col("__rank")) & (F.col("__upto") - F.col("__n") < F.col("__rank"))
        found = settle(running.where(held), "select-level")
        one = F.col("__low").eqNullSafe(F.col("__high"))
        ready = found.where(one | F.lit(shift == 0)).select(*by, F.col("__low").alias("__chosen"))
        done = ready if done is None else done.union(ready)
        left = found.where(~one)
        if shift == 0 or left.isEmpty():
            break
        # The rank among the bucket's own rows.
        rank = F.col("__rank") - (F.col("__upto") - F.col("__n"))
        targets = left.select(*by, rank.alias("__rank"), F.col("__bucket").alias("__at"))
    return done.groupBy(*keys).agg((F.sum("__chosen") / 2).alias("__middle"))


def group_median(
    counted: DataFrame, keys: Sequence[str], output: str, over: int = SELECT_OVER, bits: int = LEVEL_BITS
) -> DataFrame:
    """``keys, output``: the median of each group's values, the mean of the two middle ones if rows are even in number.

    ``counted`` is a stored table with ``keys``, ``__value`` and ``__n``, how
    many rows have the value; a value may occur in several of its rows. Rows
    with a null value or key are left out. Groups of up to ``over`` rows of
    ``counted`` are collected value by value, larger ones selected from.
    """
    usable = counted.where(all_present([*keys, "__value"]))
    large = _large_groups(usable, keys, over)
    small = usable if large.isEmpty() else usable.join(large.select(*keys), list(keys), "left_anti")
    medians = small.groupBy(*keys).agg(F.percentile("__value", F.lit(0.5), F.col("__n")).alias(output))
    if large.isEmpty():
        return medians
    return medians.union(_select(usable, keys, large, bits).withColumnRenamed("__middle", output))
