"""Item features as two small tables, for catalogues that fit a broadcast.

All values of an item depend on the item and its sizes or colours. Rows are
first summed per (item, size) and (item, colour) (``sums``); where these are small,
the features are worked out on them and joined, and order rows are not shuffled
by item at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retourlens.operators import features as f
from retourlens.operators.encoders import RobustScaler
from retourlens.operators.grouping import GroupStep, Windowed, attach, run_steps

# Key row, value row and slot of one entry, without its texts.
ROW_BYTES = 224
COUNTED = ("__known", "__returns")


def broadcast_bytes(sums: DataFrame, part: str) -> int:
    """Upper estimate of a settled table's size as a hashed relation.

    It holds a key row and a value row with the text in both, each padded.
    """
    text = F.coalesce(F.sum(F.octet_length(part) + 8), F.lit(0))
    return sums.select(F.count("*") * ROW_BYTES + 2 * text).first()[0]


def size_table(sums: DataFrame, support: f.Support) -> DataFrame:
    """``item_id, item_size`` as text, and what follows from them.

    Windows are safe here: no group is larger than the table itself.
    """
    totals = {"__all_price": F.sum("__price"), "__all_prices": F.sum("__prices")}
    steps = [
        GroupStep(["item_id"], totals),
        f.item_encoder(support).step(COUNTED),
        f.item_type_step(),
    ]
    known = run_steps(sums.withColumn("is_unknown", F.lit(False)), steps, Windowed())
    rated = f.size_encoder(support).from_sums(known, *COUNTED)
    numbered = f.numeric_size(rated.withColumn("__text", F.col("item_size")))
    scaler = RobustScaler(["item_id"], "item_size", "item_size", weight="__rows")
    return scaler.transform(numbered, Windowed()).select(
        "item_id",
        F.col("__text").alias("item_size"),
        F.col("item_size").alias("__size"),
        (F.col("__all_price") / F.nullif("__all_prices", F.lit(0))).alias("__mean_price"),
        "ce_item",
        "type",
        "size_item_ce",
    )


def colour_table(sums: DataFrame, support: f.Support) -> DataFrame:
    rated = f.colour_encoder(support).from_sums(sums, *COUNTED)
    return rated.select("item_id", "item_color", "colour_item_ce")


def attach_items(df: DataFrame, sizes: DataFrame, colours: DataFrame, support: f.Support) -> DataFrame:
    """Add all item features; both sums must be small enough to broadcast.

    Rows without an item are in no table and get what other forms give to a
    group without values.
    """
    by_size = F.broadcast(size_table(sizes, support))
    by_colour = F.broadcast(colour_table(colours, support))
    df = attach(df, by_size, ["item_id", "item_size"], null_safe=["item_size"])
    df = attach(df, by_colour, ["item_id", "item_color"])
    no_item = F.col("item_id").isNull()
    df = df.withColumns(
        {
            "type": F.when(no_item, F.lit(f.OTHER_TYPE)).otherwise(F.col("type")),
            "ce_item": F.when(no_item, f.item_encoder(support).unseen()).otherwise(F.col("ce_item")),
        }
    )
    return f.flag_discount(df.drop("item_size").withColumnRenamed("__size", "item_size"))
