import re

import pytest
from pyspark.sql import functions as F

from retourlens.operators import decisions, ensemble
from retourlens.sources.stored import store_by_id


@pytest.fixture(scope="module")
def tables(spark):
    rows = spark.range(5_000).select(
        F.col("id").alias("order_item_id"), (F.col("id") % 90 + 1).cast("double").alias("item_price"),
        (F.col("id") % 3 == 0).cast("int").alias("returned"), (F.col("id") % 10).cast("int").alias("fold"),
        (F.hash("id") % 100 / 200 + 0.5).alias("score"),
    )
    return rows, store_by_id(rows.drop("score", "fold"), "features", 7), store_by_id(rows.select("fold", "order_item_id", "score"), "scores", 7)


def joined(spark, make):
    """The executed plan and the rows, with joins by sort as for large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = make()
        return df._jdf.queryExecution().executedPlan().toString(), sorted(map(tuple, df.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("operator", [lambda f, s: decisions.decide(f, s), lambda f, s: ensemble.out_of_fold(s, f)])
def test_stored_sides_stay_where_they_are(spark, tables, operator):
    rows, features, scores = tables
    plan, found = joined(spark, lambda: operator(features, scores))
    assert "Exchange" not in plan and "Join" in plan
    assert found == joined(spark, lambda: operator(rows, rows))[1]


def test_only_the_other_side_moves(spark, tables):
    rows, features, _ = tables
    plan, found = joined(spark, lambda: decisions.decide(features, rows.select("order_item_id", "score")))
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1 and len(found) == 5_000


def test_null_ids_are_stored(spark):
    table = spark.createDataFrame([(None, 1.0), (2, 2.0)], "order_item_id long, score double")
    assert store_by_id(table, "nulls", 3).count() == 2
