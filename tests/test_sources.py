from datetime import date

import pytest
from pyspark.sql import functions as F

from retourlens.operators import tables
from retourlens.session import scratch_path, settle, shared_dir
from retourlens.sources import orders


def order(i, returned=1):
    day = date(2020, 1, 1)
    return (i, day, None, 10, "XL", "blau", 3, 12.5, 7, "Mrs", None, "Berlin", day, returned)


def test_orders_through_csv(spark):
    df = spark.createDataFrame([order(1), order(2, 0)], orders.ORDER_SCHEMA)
    path = scratch_path(spark, "orders")
    df.write.option("header", True).csv(path)
    assert sorted(orders.read_orders(spark, path).collect()) == sorted(df.collect())


def test_wrong_header_is_an_error(spark):
    path = scratch_path(spark, "orders")
    spark.createDataFrame([order(1)], orders.ORDER_SCHEMA).withColumnRenamed("item_id", "brand").write.option(
        "header", True
    ).csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        orders.read_orders(spark, path).collect()


@pytest.mark.parametrize("column, value", [("item_price", "12x"), ("item_id", "ten"), ("order_date", "soon")])
def test_malformed_values_are_errors(spark, column, value):
    path = scratch_path(spark, "orders")
    df = spark.createDataFrame([order(1)], orders.ORDER_SCHEMA)
    df.withColumn(column, F.lit(value)).write.option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        orders.read_orders(spark, path).collect()


def test_unlabelled_orders_through_csv(spark):
    df = spark.createDataFrame([order(1)[:-1]], orders.UNLABELLED_SCHEMA)
    path = scratch_path(spark, "orders")
    df.write.option("header", True).csv(path)
    assert orders.read_orders(spark, path, orders.UNLABELLED_SCHEMA).collect() == df.collect()


@pytest.mark.parametrize("fmt", ["csv", "parquet", "orc"])
def test_features_and_predictions(spark, fmt):
    df = spark.range(3).select(F.col("id").alias("order_item_id"), (F.col("id") / 4).alias("p"))
    path = scratch_path(spark, "p")
    orders.write_predictions(df, path, score="p", fmt=fmt)
    back = orders.read_predictions(spark, path, fmt=fmt)
    assert back.columns == ["order_item_id", "score"]
    assert sorted(map(tuple, back.collect())) == [(0, 0.0), (1, 0.25), (2, 0.5)]
    path = scratch_path(spark, "f")
    orders.write_features(df, path, fmt)
    assert orders.read_features(spark, path, fmt, df.schema).columns == ["order_item_id", "p"]


def test_stack_and_split(spark):
    known = spark.createDataFrame([order(1)], orders.ORDER_SCHEMA)
    unknown = spark.createDataFrame([order(2)[:-1]], orders.UNLABELLED_SCHEMA)
    both = tables.stack_splits(known, unknown)
    assert {(r["order_item_id"], r["is_unknown"], r["returned"]) for r in both.collect()} == {
        (1, False, 1), (2, True, None)
    }
    back, rest = tables.split(both)
    assert back.columns == known.columns and rest.columns == unknown.columns


def test_rekey_rename_reorder(spark):
    df = spark.createDataFrame([(3, 4, 1)], "item_id long, brand_id long, returned int")
    assert tuple(tables.rekey(df).first()) == (8, 104, 1)
    moved = tables.reorder(tables.rename(df, {"item_id": "item"}), last="item")
    assert moved.columns == ["brand_id", "returned", "item"]
    assert tables.count_flagged(df, "returned").first()[0] == 1


def test_settled_table_knows_its_size(spark):
    wide = spark.range(1000).groupBy((F.col("id") % 3).alias("k")).count()
    table = settle(wide, "small")
    assert table.count() == 3 and shared_dir(spark) in table.inputFiles()[0]
    plan = spark.range(10).join(table, F.col("id") == F.col("k"))._jdf.queryExecution().executedPlan()
    assert "BroadcastHashJoin" in plan.toString()
