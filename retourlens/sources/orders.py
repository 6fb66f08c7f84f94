"""Order, feature and prediction tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BASE_FIELDS = [
    T.StructField("order_item_id", T.LongType(), False),
    T.StructField("order_date", T.DateType(), False),
    T.StructField("delivery_date", T.DateType(), True),
    T.StructField("item_id", T.LongType(), False),
    T.StructField("item_size", T.StringType(), True),
    T.StructField("item_color", T.StringType(), True),
    T.StructField("brand_id", T.LongType(), False),
    T.StructField("item_price", T.DoubleType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("user_title", T.StringType(), True),
    T.StructField("user_dob", T.DateType(), True),
    T.StructField("user_state", T.StringType(), True),
    T.StructField("user_reg_date", T.DateType(), False),
]
LABEL = T.StructField("returned", T.IntegerType(), True)
ORDER_SCHEMA = T.StructType([*_BASE_FIELDS, LABEL])
UNLABELLED_SCHEMA = T.StructType(_BASE_FIELDS)
PREDICTION_SCHEMA = T.StructType(
    [T.StructField("order_item_id", T.LongType()), T.StructField("score", T.DoubleType())]
)


def _reader(spark: SparkSession, schema: T.StructType | None):
    return spark.read if schema is None else spark.read.schema(schema)


def _scan(spark: SparkSession, path: str, schema: T.StructType | None, fmt: str) -> DataFrame:
    reader = _reader(spark, schema)
    if fmt == "csv":
        # enforceSchema off: a header that differs from the schema is an error,
        # not columns silently taken by position.
        # Malformed values are errors too, not nulls.
        return reader.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    return reader.format(fmt).load(path)


def _write(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def read_orders(
    spark: SparkSession, path: str, schema: T.StructType = ORDER_SCHEMA, fmt: str = "csv"
) -> DataFrame:
    return _scan(spark, path, schema, fmt)


def write_features(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    _write(df, path, fmt, mode)


def read_features(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    if fmt == "csv" and schema is None:
        raise ValueError("a csv feature table needs a schema")
    return _scan(spark, path, schema, fmt)


def write_predictions(
    df: DataFrame,
    path: str,
    score: str = "score",
    fmt: str = "csv",
    mode: str = "errorifexists",
) -> None:
    """Two columns: the row id and the score (or the 0/1 decision)."""
    _write(df.select("order_item_id", F.col(score).alias("score")), path, fmt, mode)


def read_predictions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _scan(spark, path, PREDICTION_SCHEMA, fmt)
