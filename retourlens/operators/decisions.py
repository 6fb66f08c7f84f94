"""From return probabilities to warnings, and what they earn or cost."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retourlens.functions.scalar import flag, grid_point

# Share of a price lost by a needless warning; cost of an
# unannounced return as a weight on a base charge and a share of the price.
WARNED_LOSS = 0.5
RETURN_WEIGHT = 5
RETURN_BASE, RETURN_SHARE = 3, 0.1
REVENUE_GRID = (0.8, 1.7, 100)
COST_GRID = (0.98, 1.1, 100)


def _price(price: Column | str) -> Column:
    return F.col(price) if isinstance(price, str) else price


def lost_sale(price: Column | str) -> Column:
    """A warned customer who would have kept the item."""
    return F.lit(WARNED_LOSS) * -_price(price)


def missed_return(price: Column | str) -> Column:
    """A return that was not warned about."""
    charge = F.lit(RETURN_BASE) + F.lit(RETURN_SHARE) * _price(price)
    return F.lit(0.5 * RETURN_WEIGHT) * -charge


def tau(price: Column | str = "item_price") -> Column:
    """Score at which warning and not warning cost the same; null where there
    is none, at the negative price whose two costs cancel out."""
    return lost_sale(price) / F.nullif(lost_sale(price) + missed_return(price), F.lit(0.0))


def with_tau(df: DataFrame) -> DataFrame:
    return df.withColumn("tau", tau("item_price"))


def warn(df: DataFrame, m: float = 1.0) -> DataFrame:
    """1 where the score reaches the break-even point times ``m``."""
    return with_tau(df).withColumn("warn", flag(F.col("tau") * F.lit(float(m)) <= F.col("score")))


def _outcome(returned: Column, warned: Column, price: Column, kept: Column) -> Column:
    return (
        F.when(returned > warned, missed_return(price))
        .when(warned > returned, lost_sale(price))
        .when((returned == 1) & (warned == 1), F.lit(0.0))
        .otherwise(kept)
    )


def revenue_value(returned: Column, warned: Column, price: Column) -> Column:
    return _outcome(returned, warned, price, price)


def cost_value(returned: Column, warned: Column, price: Column) -> Column:
    return _outcome(returned, warned, price, F.lit(0.0))


METRICS: dict[str, Callable[[Column, Column, Column], Column]] = {
    "revenue": revenue_value,
    "error_cost": cost_value,
}


def revenue(df: DataFrame) -> DataFrame:
    value = revenue_value(F.col("returned"), F.col("warn"), F.col("item_price"))
    return df.withColumn("revenue", value)


def error_cost(df: DataFrame) -> DataFrame:
    value = cost_value(F.col("returned"), F.col("warn"), F.col("item_price"))
    return df.withColumn("error_cost", value)


def _with_flip(df: DataFrame, start: float, stop: float, count: int) -> DataFrame:
    """Add ``i``: how many leading grid multipliers share one decision.

    ``tau * m <= score`` flips once as ``m`` grows. Division gives the place
    up to rounding, then the comparison itself at the points around it settles
    it, so ``i`` is what a test of every grid point would give. For a negative
    ``tau`` (a negative price) the decision starts at 0 and flips to 1.
    """
    point, score = F.col("tau"), F.col("score")
    step = (stop - start) / (count - 1)
    place = (score / F.nullif(point, F.lit(0.0)) - start) / step
    floor = F.floor(F.least(F.greatest(place, F.lit(0.0)), F.lit(float(count)))).cast("int")

    def before(index: Column) -> Column:
        product = point * grid_point(index, start, stop, count)
        reached = F.when(point >= 0, product <= score).otherwise(product > score)
        return flag(reached & (index < count))

    first = F.col("__first")
    near = sum((before(first + ahead) for ahead in range(4)), first)
    always = F.when(F.lit(0.0) <= score, F.lit(count)).otherwise(F.lit(0))
    return (
        df.withColumn("__first", F.greatest(floor - 1, F.lit(0)))
        .withColumn("i", F.coalesce(F.when(point == 0, always).otherwise(near), F.lit(0)))
        .drop("__first")
    )


def sweep(
    df: DataFrame, metric: str, start: float, stop: float, count: int, digits: int = 2
) -> DataFrame:
    """Total ``metric`` for each of ``count`` multipliers: ``i, m, <metric>``.

    Rows are not multiplied by the grid: each one is added at the grid point
    where its decision flips, and running totals over the at most ``count + 1``
    places give every grid point's sum.
    """
    value = METRICS[metric]
    returned, price, scored = F.col("returned"), F.col("item_price"), F.col("score").isNotNull()
    early = F.when(scored & (F.col("tau") >= 0), 1).otherwise(0)
    late = F.when(scored & (F.col("tau") < 0), 1).otherwise(0)
    placed = _with_flip(with_tau(df), start, stop, count).select(
        "i", value(returned, early, price).alias("early"), value(returned, late, price).alias("late")
    )
    sums = placed.groupBy("i").agg(F.sum("early").alias("early"), F.sum("late").alias("late"))
    places = df.sparkSession.range(count + 1).select(F.col("id").cast("int").alias("i"))
    order = Window.partitionBy(F.lit(0)).orderBy("i")
    to_come = order.rowsBetween(1, Window.unboundedFollowing)
    passed = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.coalesce(F.sum("early").over(to_come), F.lit(0.0)) + F.coalesce(
        F.sum("late").over(passed), F.lit(0.0)
    )
    return (
        places.join(sums, "i", "left")
        .select("i", F.round(total, digits).alias(metric))
        .where(F.col("i") < count)
        .select("i", grid_point(F.col("i"), start, stop, count).alias("m"), metric)
    )


def revenue_sweep(df: DataFrame) -> DataFrame:
    return sweep(df, "revenue", *REVENUE_GRID)


def cost_sweep(df: DataFrame) -> DataFrame:
    return sweep(df, "error_cost", *COST_GRID)


def decide(features: DataFrame, predictions: DataFrame, m: float = 1.0) -> DataFrame:
    """``order_item_id, warn`` for every prediction; both inputs have one row an id.

    A prediction without a feature row has no price and is not warned about.
    """
    priced = features.select("order_item_id", "item_price")
    scored = predictions.select("order_item_id", "score").join(priced, "order_item_id", "left")
    return warn(scored, m).select("order_item_id", "warn")


def cost_summary(df: DataFrame, digits: int = 4) -> DataFrame:
    """Totals of decided rows: warnings, revenue, error cost and its mean."""
    return error_cost(revenue(df)).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("warn") == 1).alias("n_warned"),
        F.round(F.sum("revenue"), digits).alias("total_revenue"),
        F.round(F.sum("error_cost"), digits).alias("total_cost"),
        F.round(F.avg("error_cost"), digits).alias("mean_cost"),
    )


def confusion(df: DataFrame, digits: int = 4) -> DataFrame:
    """Rows, revenue and error cost of the four label and decision pairs."""
    return (
        error_cost(revenue(df))
        .groupBy("returned", "warn")
        .agg(
            F.count("*").alias("n_rows"),
            F.round(F.sum("revenue"), digits).alias("revenue"),
            F.round(F.sum("error_cost"), digits).alias("error_cost"),
        )
    )
