"""Feature operators over order items of both splits.

Input frames carry ``is_unknown`` and the raw order columns. Operators that
read a group take the ``form`` to do it in; see ``grouping``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retourlens.functions.scalar import (
    days_between,
    fill,
    fix_colour,
    flag,
    indicator_columns,
    is_digits,
    overwrite_where,
    round_half_even,
    size_number,
    size_text,
)
from retourlens.operators.encoders import RobustScaler, TargetEncoder
from retourlens.operators.grouping import Form, GroupStep, Joined

# Size ranges that tell item types apart, stand-ins for gaps.
ITEM_TYPES = (1, 2, 3, 4, 5, 6, 7)
# Items whose sizes tell nothing else.
OTHER_TYPE = 2
SMALL_MIN, SMALL_MAX = 15, 25
TROUSER_MIN = 2000
CHILD_MIN, CHILD_MAX = 80, 200
UNSIZED = "unsized"
NO_EARLIER_ORDER, NO_EARLIER_ITEM_ORDER = -1, 0
NOT_DELIVERED_DAYS = 9999
DAYS_PER_YEAR = 365


@dataclass(frozen=True)
class Support:
    """Labelled rows a key needs before its own rate is used."""

    brand: int = 100
    item: int = 40
    user: int = 5
    price: int = 90
    pair: int = 45


def brand_encoder(support: Support = Support()) -> TargetEncoder:
    return TargetEncoder(["brand_id"], "ce_brand", support.brand)


def item_encoder(support: Support = Support()) -> TargetEncoder:
    return TargetEncoder(["item_id"], "ce_item", support.item)


def user_encoder(support: Support = Support()) -> TargetEncoder:
    return TargetEncoder(["user_id"], "ce_user", support.user)


def price_encoder(support: Support = Support()) -> TargetEncoder:
    """Expects the rounded price."""
    return TargetEncoder(["item_price"], "ce_price", support.price)


def colour_encoder(support: Support = Support()) -> TargetEncoder:
    """Expects the corrected colour."""
    return TargetEncoder(["item_id", "item_color"], "colour_item_ce", support.pair, ratio_digits=None)


def size_encoder(support: Support = Support()) -> TargetEncoder:
    """Expects the normalised size text, before it is turned into a number."""
    return TargetEncoder(["item_id", "item_size"], "size_item_ce", support.pair, ratio_digits=None)


def rounded_price(df: DataFrame) -> DataFrame:
    return df.withColumn("item_price", round_half_even("item_price"))


def flag_discount(df: DataFrame) -> DataFrame:
    """1 where the price is below the item's ``__mean_price``, which goes."""
    below = flag(F.col("__mean_price") - F.col("item_price") > 0)
    return df.withColumn("is_discounted", below).drop("__mean_price")


def discount_step() -> GroupStep:
    """Item's mean price above the row's price; expects the rounded price."""
    return GroupStep(["item_id"], {"__mean_price": F.avg("item_price")}, flag_discount)


def is_discounted(df: DataFrame, form: Form = Joined()) -> DataFrame:
    return discount_step().run(df, form)


def orders_per_day(df: DataFrame, form: Form = Joined()) -> DataFrame:
    return form.values(df, ["user_id", "order_date"], {"orders_per_day": F.count("*")})


def multi_colour_per_day(df: DataFrame, form: Form = Joined()) -> DataFrame:
    """Rows of a user, item and colour as spelled in the input."""
    keys = ["user_id", "item_id", "item_color"]
    return form.values(df, keys, {"multi_colour_per_day": F.count("*")})


def corrected_colour(df: DataFrame) -> DataFrame:
    return df.withColumn("item_color", fix_colour("item_color"))


def count_item_user(df: DataFrame, form: Form = Joined()) -> DataFrame:
    return form.values(df, ["user_id", "item_id"], {"count_item_user": F.count("*")})


def customer_value_step() -> GroupStep:
    """Spend per user; expects the rounded price."""
    return GroupStep(["user_id"], {"customer_value": F.sum("item_price")})


def customer_value(df: DataFrame, form: Form = Joined()) -> DataFrame:
    return customer_value_step().run(df, form)


def count_user_step() -> GroupStep:
    return GroupStep(["user_id"], {"count_user": F.count("*")})


def count_user(df: DataFrame, form: Form = Joined()) -> DataFrame:
    return count_user_step().run(df, form)


def new_user(df: DataFrame) -> DataFrame:
    return df.withColumn("new_user", flag(F.col("count_user") <= 1))


def normalised_size_text(df: DataFrame) -> DataFrame:
    return df.withColumn("item_size", size_text("item_size"))


def item_type_step() -> GroupStep:
    """``type`` 1-7 of each item from all its size texts; null sizes are ignored."""
    size = F.col("item_size")
    number = F.when(is_digits(size), size.try_cast("double"))
    ranges = {
        "__half": F.bool_or(F.contains(size, F.lit(".5"))),
        "__digits": F.bool_and(is_digits(size)),
        "__unsized": F.bool_and(size == UNSIZED),
        "__low": F.min(number),
        "__high": F.max(number),
    }
    low, high = F.col("__low"), F.col("__high")
    numeric = (
        F.when((low < SMALL_MIN) & (high < SMALL_MAX), 3)
        .when(low > TROUSER_MIN, 4)
        .when((low > CHILD_MIN) & (high < CHILD_MAX), 5)
        .otherwise(6)
    )
    kind = (
        F.when(F.col("__half"), 1)
        .when(F.col("__digits"), numeric)
        .when(F.col("__unsized"), 7)
        .otherwise(OTHER_TYPE)
    )

    def finish(df: DataFrame) -> DataFrame:
        return df.withColumn("type", kind).drop(*ranges)

    return GroupStep(["item_id"], ranges, finish)


def classify_items(df: DataFrame, form: Form = Joined()) -> DataFrame:
    return item_type_step().run(df, form)


def type_dummies(df: DataFrame) -> DataFrame:
    return df.withColumns(indicator_columns("type", ITEM_TYPES, "type")).drop("type")


def numeric_size(df: DataFrame) -> DataFrame:
    return df.withColumn("item_size", size_number("item_size"))


def normalised_size(df: DataFrame, form: Form = Joined()) -> DataFrame:
    """Expects the numeric size."""
    return RobustScaler(["item_id"], "item_size", "item_size").transform(df, form)


def was_delivered(df: DataFrame) -> DataFrame:
    return df.withColumn("was_delivered", flag(F.col("delivery_date").isNotNull()))


def latest_order(df: DataFrame, form: Form = Joined()) -> DataFrame:
    return form.days_since_previous(
        df, ["user_id"], "order_date", NO_EARLIER_ORDER, "latest_order"
    )


def ordered_item_recently(df: DataFrame, form: Form = Joined()) -> DataFrame:
    keys = ["user_id", "item_id"]
    return form.days_since_previous(
        df, keys, "order_date", NO_EARLIER_ITEM_ORDER, "ordered_item_recently"
    )


def membership_age(df: DataFrame) -> DataFrame:
    days = days_between("user_reg_date", "order_date")
    return df.withColumn("membership_age_days", overwrite_where(days, days == -1, 0))


def time_to_delivery(df: DataFrame) -> DataFrame:
    days = days_between("order_date", "delivery_date")
    value = fill(overwrite_where(days, days < 0, -1), NOT_DELIVERED_DAYS)
    return df.withColumn("time_to_delivery_days", value)


def assumed_age(df: DataFrame) -> DataFrame:
    years = fill(days_between("user_dob", "order_date") / F.lit(DAYS_PER_YEAR), 0.0)
    return df.withColumn("assumed_age", round_half_even(years))
