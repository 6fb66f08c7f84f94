"""Raw order items to the model's feature table.

Building the plan runs a few jobs that settle small tables; the rows themselves
move when the result is used.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from retourlens.operators import features as f
from retourlens.operators import tables
from retourlens.operators.grouping import MAX_GROUP_ROWS, Form, per_group, run_steps
from retourlens.plans.item_tables import COUNTED, ROW_BYTES, attach_items, broadcast_bytes
from retourlens.plans.sums import group_sums

IDS = ["order_item_id", "item_id", "brand_id", "user_id"]
LABEL = "returned"
FEATURES = [
    "item_size", "item_price", "ce_brand", "ce_item", "ce_user", "ce_price",
    "is_discounted", "orders_per_day", "multi_colour_per_day", "colour_item_ce",
    "count_item_user", "customer_value", "count_user", "new_user", "size_item_ce",
    *[f"type_{t}" for t in f.ITEM_TYPES],
    "was_delivered", "latest_order", "ordered_item_recently",
    "membership_age_days", "time_to_delivery_days", "assumed_age",
]
ITEM_INPUTS = ["item_id", "item_size", "item_color", "item_price", "is_unknown", LABEL]
SUM_INPUTS = [*ITEM_INPUTS, "brand_id", "user_id"]
# Size up to which an item table is broadcast.
MAX_ITEM_BYTES = 48 * 1024 * 1024
UNUSED = ["user_state", "user_title"]


@dataclass(frozen=True)
class FeatureConfig:
    support: f.Support = field(default_factory=f.Support)
    max_group_rows: int = MAX_GROUP_ROWS
    max_item_bytes: int = MAX_ITEM_BYTES


def _per_user(support: f.Support):
    """All values of a user's rows. Windows are ordered so that each group of
    them finds its rows already sorted: by date, then by item and date."""

    def build(df: DataFrame, form: Form) -> DataFrame:
        df = f.latest_order(df, form)
        own = [f.customer_value_step(), f.count_user_step(), f.user_encoder(support).step()]
        df = run_steps(df, own, form)
        df = f.orders_per_day(df, form)
        df = f.ordered_item_recently(df, form)
        df = f.count_item_user(df, form)
        return f.multi_colour_per_day(df, form)

    return build


def _per_item(support: f.Support):
    """All values of an item's rows; colour and size text are corrected by now."""

    def build(df: DataFrame, form: Form) -> DataFrame:
        own = [f.discount_step(), f.item_encoder(support).step(), f.item_type_step()]
        df = run_steps(df, own, form)
        df = f.colour_encoder(support).fit_transform(df, form)
        df = f.size_encoder(support).fit_transform(df, form)
        return f.normalised_size(f.numeric_size(df), form.prepare(f.numeric_size))

    return build


def _corrected(df: DataFrame) -> DataFrame:
    return f.normalised_size_text(f.corrected_colour(df))


def build_features_stacked(sales: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Feature table of rows that already carry ``is_unknown``.

    Rows move once, to their user, where the catalogue is small enough to
    broadcast, and a second time, to their item, where it is not. What is
    fitted or measured beforehand comes from one pass of ``group_sums``, and
    from a second one over sizes and colours if there are few items; brand and
    price rates are joined as the small tables they are.
    """
    support, limit = config.support, config.max_group_rows
    rows = f.rounded_price(tables.drop(sales, UNUSED))
    items = _corrected(rows.select(*ITEM_INPUTS))
    brand, price = f.brand_encoder(support), f.price_encoder(support)
    ready = group_sums(_corrected(rows.select(*SUM_INPUTS)), limit)
    rates = {"brand": brand.rates(ready.brand, *COUNTED), "price": price.rates(ready.price, *COUNTED)}
    out = _corrected(per_group(rows, "user_id", _per_user(support), ready.hot_users))
    small = None
    # The number of items is an estimate; the sums themselves are measured exactly.
    if 0 < config.max_item_bytes and ready.items * ROW_BYTES <= 2 * config.max_item_bytes:
        small = ready.catalogue()
        if any(broadcast_bytes(t, c) > config.max_item_bytes for t, c in zip(small, ("item_size", "item_color"))):
            small = None
    if small:
        out = attach_items(out, *small, support)
    else:
        out = per_group(out, "item_id", _per_item(support), ready.hot_items, items)
    out = price.transform(brand.transform(out, rates["brand"]), rates["price"])
    out = f.new_user(f.type_dummies(out))
    out = f.assumed_age(f.time_to_delivery(f.membership_age(f.was_delivered(out))))
    return tables.reorder(out, [*IDS, *FEATURES, "is_unknown", LABEL])


def build_features(
    known: DataFrame, unknown: DataFrame, config: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """Feature table of two input tables; ids of the second are aligned first."""
    return build_features_stacked(tables.stack_splits(known, tables.rekey(unknown)), config)
