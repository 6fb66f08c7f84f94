"""Scalar expressions; each one is a built-in Spark column expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spelling corrections and the numbers of letter sizes.
COLOUR_SPELLING = {"blau": "blue", "brwon": "brown", "oliv": "olive"}
LETTER_SIZES = {
    "unsized": "0",
    "xs": "1",
    "s": "2",
    "m": "3",
    "l": "4",
    "xl": "5",
    "xxl": "6",
    "xxxl": "7",
}
HALF_SIZE_SIGN, HALF_SIZE_TEXT = "+", ".5"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_even(value: Column | str, digits: int = 0) -> Column:
    """Scale, round half to even, scale back.

    ``F.round`` and ``F.bround`` round the decimal text of the number and give
    0.58 for 0.575; scaling first gives 0.57. Adding 0.0 turns -0.0 into 0.0.
    """
    column = _col(value)
    if digits == 0:
        return F.rint(column) + F.lit(0.0)
    scale = F.lit(float(10**digits))
    return F.rint(column * scale) / scale + F.lit(0.0)


def overwrite_where(value: Column | str, condition: Column, replacement) -> Column:
    """``replacement`` where ``condition`` holds, the old value elsewhere."""
    new = replacement if isinstance(replacement, Column) else F.lit(replacement)
    return F.when(condition, new).otherwise(_col(value))


def fill(value: Column | str, replacement) -> Column:
    return F.coalesce(_col(value), F.lit(replacement))


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or null."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def map_values(value: Column | str, mapping: dict[str, str]) -> Column:
    """Exact-match replacement; values without an entry pass through."""
    column = _col(value)
    pairs = [F.lit(text) for entry in mapping.items() for text in entry]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), column)


def fix_colour(value: Column | str = "item_color") -> Column:
    return map_values(value, COLOUR_SPELLING)


def size_text(value: Column | str = "item_size") -> Column:
    """Lower case, and a plus sign written as a half size."""
    return F.replace(F.lower(_col(value)), F.lit(HALF_SIZE_SIGN), F.lit(HALF_SIZE_TEXT))


def is_digits(value: Column | str) -> Column:
    return _col(value).rlike("^[0-9]+$")


def size_number(value: Column | str) -> Column:
    """Letter sizes by table, the rest parsed; bad text raises in ANSI mode."""
    return map_values(value, LETTER_SIZES).cast("double")


def parse_date(value: Column | str, strict: bool = True) -> Column:
    column = _col(value)
    return F.to_date(column) if strict else F.try_to_date(column)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start))


def indicator_columns(value: Column | str, values, prefix: str) -> dict[str, Column]:
    """One 0/1 column for each listed value, the same set for every input."""
    column = _col(value)
    return {f"{prefix}_{v}": flag(column == F.lit(v)) for v in values}


def hash_number(identifier: Column | str, seed: int) -> Column:
    """32-bit number from the md5 of ``id:seed``; independent of partitioning."""
    text = F.concat_ws(":", _col(identifier).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def truncate(value: Column | str) -> Column:
    """The whole number towards zero, as an int."""
    return _col(value).cast("int")


def grid_point(index: Column, start: float, stop: float, count: int) -> Column:
    """Value ``index`` of ``count`` evenly spaced points, both ends included."""
    step = (stop - start) / (count - 1)
    inner = index.cast("double") * F.lit(step) + F.lit(float(start))
    return F.when(index >= F.lit(count - 1), F.lit(float(stop))).otherwise(inner)


def linspace_df(spark: SparkSession, start: float, stop: float, count: int) -> DataFrame:
    """Evenly spaced grid as ``(i int, m double)``."""
    index = F.col("id").cast("int")
    return spark.range(count).select(index.alias("i"), grid_point(index, start, stop, count).alias("m"))


def linspace_ints(start: float, stop: float, count: int) -> list[int]:
    """The same grid truncated to integers, for driver-side parameter lists."""
    step = (stop - start) / (count - 1)
    return [int(stop) if i == count - 1 else int(start + i * step) for i in range(count)]
