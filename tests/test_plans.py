import os
import re

import pytest
from pyspark.sql import functions as F

from checks.queries import MIXED, all_queries
from retourlens.operators import features
from retourlens.operators.grouping import hot_keys, per_group
from retourlens.plans import training
from retourlens.plans.feature_table import FEATURES, FeatureConfig, build_features_stacked
from retourlens.plans.sums import summed
from retourlens.session import settle
from retourlens.sources.sales import sales

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LEARNERS = {
    "random_search", "feature_importance", "model_zoo", "zoo_submission", "forest_stump", "boosted_stump",
    "stump_importance", "importance_order", "zoo_coverage",
}

# Column totals of the whole feature table at sf0.01.
TOTALS = {
    "item_price": 3183285, "item_size": -368.07, "is_discounted": 30000, "orders_per_day": 299936,
    "multi_colour_per_day": 60152, "count_item_user": 61226, "customer_value": 143355501,
    "count_user": 2703384, "latest_order": 11655667, "ordered_item_recently": 456518,
    "membership_age_days": 58647222, "time_to_delivery_days": 62105183, "assumed_age": 1864126,
    "was_delivered": 56201, "ce_brand": 19923.04, "ce_item": 28800.00, "ce_user": 19958.02,
    "ce_price": 19951.29, "new_user": 0, "type_1": 8615, "type_2": 8638, "type_3": 8475,
    "type_4": 8363, "type_5": 8674, "type_6": 8665, "type_7": 8570,
}

needs_data = pytest.mark.skipif(not os.path.isdir(MEDIUM), reason="no benchmark tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_feature_totals(spark):
    table = build_features_stacked(sales(spark, MEDIUM))
    row = table.agg(*[F.round(F.sum(c), 2).alias(c) for c in TOTALS]).first().asDict()
    assert row == pytest.approx(TOTALS, abs=0.005)
    assert table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in FEATURES]).first() == (0,) * len(FEATURES)


@needs_data
def test_hot_and_cold_forms_agree(spark):
    rows = sales(spark, SMALL)
    cold = build_features_stacked(rows, FeatureConfig(MIXED))
    large = build_features_stacked(rows, FeatureConfig(MIXED, max_item_bytes=0))
    hot = build_features_stacked(rows, FeatureConfig(MIXED, max_group_rows=30, max_item_bytes=0))
    for other in (large, hot):
        assert other.exceptAll(cold).isEmpty() and cold.exceptAll(other).isEmpty()
    assert hot.count() == rows.count()


@needs_data
def test_missing_sizes_and_colours_agree(spark):
    rows = sales(spark, SMALL).withColumns(
        {
            "item_size": F.when(F.col("order_item_id") % 5 != 0, F.col("item_size")),
            "item_color": F.when(F.col("order_item_id") % 7 != 0, F.col("item_color")),
        }
    )
    joined = build_features_stacked(rows, FeatureConfig(MIXED))
    windowed = build_features_stacked(rows, FeatureConfig(MIXED, max_item_bytes=0))
    assert joined.exceptAll(windowed).isEmpty() and windowed.exceptAll(joined).isEmpty()
    assert joined.where("item_size is null and size_item_ce is null and type_1 is not null").count() > 0


GAPS = {
    **{c: (c,) for c in ("item_id", "user_id", "brand_id", "item_price", "item_size", "item_color")},
    "all": ("item_id", "user_id", "brand_id", "item_price", "item_size", "item_color"),
}


@needs_data
@pytest.mark.parametrize("gap", GAPS)
def test_nulls_give_one_answer_in_every_form(spark, gap):
    """A fifth of a column null; small limits make keys, null among them, hot."""
    lacking = {c: F.when(F.col("order_item_id") % (5 + i) != 0, F.col(c)) for i, c in enumerate(GAPS[gap])}
    rows = settle(sales(spark, SMALL).withColumns(lacking), "gaps")
    forms = {
        "broadcast": FeatureConfig(MIXED),
        "windowed": FeatureConfig(MIXED, max_item_bytes=0),
        "hot": FeatureConfig(MIXED, max_group_rows=30, max_item_bytes=0),
    }
    tables = {n: settle(build_features_stacked(rows, c), n) for n, c in forms.items()}
    first = tables.pop("broadcast")
    assert first.count() == rows.count()
    for other in tables.values():
        assert other.exceptAll(first).isEmpty() and first.exceptAll(other).isEmpty()


@needs_data
def test_a_hot_null_is_not_put_into_a_window(spark):
    rows = sales(spark, SMALL).withColumn("user_id", F.when(F.col("order_item_id") % 3 == 0, F.col("user_id")))
    hot = hot_keys(rows, "user_id", 1000)
    assert [tuple(r) for r in hot.collect()] == [(None,)]
    seen = []
    per_group(rows, "user_id", lambda df, form: seen.append(type(form).__name__) or df, hot)
    assert sorted(seen) == ["Absent", "Windowed"]


@needs_data
def test_fits_read_only_their_folds(spark):
    train, unknown = training.training_tables(build_features_stacked(sales(spark, SMALL)), 3)
    text = plan(train.where("fold != 1"))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text)[1]
    assert "fold" in filters and "is_unknown" in filters
    assert unknown.columns == ["order_item_id", "item_price", "features"] and unknown.count() > 0


def test_files_of_training_rows_are_bounded(spark, monkeypatch):
    """However many rows a writer has, a stored file has few, so no fit reads more than some files' rows in a task."""
    monkeypatch.setattr(training, "FILE_ROWS", 40)
    known = F.col("id") % 4 != 0
    values = [(F.col("id") % (3 + i)).cast("double").alias(c) for i, c in enumerate(training.FEATURES) if c != "item_price"]
    table = spark.range(0, 900, 1, 1).select(
        F.col("id").alias("order_item_id"), F.lit(20.0).alias("item_price"), (~known).alias("is_unknown"),
        F.when(known, (F.col("id") % 2).cast("int")).otherwise(0).alias("returned"), *values,
    )
    train, unknown = training.training_tables(table, 2)
    files = train.groupBy(F.input_file_name()).count().collect()
    assert train.count() == 675 and unknown.count() == 225
    assert len(files) >= 675 // 40 and max(r["count"] for r in files) <= 40


@needs_data
def test_two_scans_of_the_input(spark):
    """One for everything that is fitted beforehand, one for the features."""
    rows = sales(spark, SMALL)
    before = plan(summed(features.rounded_price(rows), 2_000_000))
    after = plan(build_features_stacked(rows))
    for text in (before, after):
        assert len(re.findall(r"FileScan parquet .*lineitem\.parquet", text)) == 1
    assert "Expand" in before and len(re.findall(r"FileScan parquet", after)) <= 8


@needs_data
def test_rows_move_to_users_and_a_large_catalogue_to_items(spark):
    """The adapter itself shuffles by order, once."""
    rows = sales(spark, SMALL)
    large = plan(build_features_stacked(rows, FeatureConfig(max_item_bytes=0)))
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", large)
    assert sorted(keys) == ["item_id", "l_orderkey", "user_id"]
    small = plan(build_features_stacked(rows))
    assert re.findall(r"Exchange hashpartitioning\((user_id|l_orderkey)#", small) == ["user_id", "l_orderkey"]
    assert "SortMergeJoin" not in small.split("Exchange hashpartitioning(user_id")[0].split("BroadcastExchange")[0]


@needs_data
@pytest.mark.parametrize("name", sorted(set(all_queries()) - LEARNERS - {"gbt_scores", "forest_scores", "mlp_scores", "greedy_ensemble", "csv_roundtrip"}))
def test_no_python_no_products(spark, name):
    text = plan(all_queries()[name](spark, SMALL))
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


@needs_data
def test_scan_reads_only_what_it_needs(spark):
    text = plan(all_queries()["is_discounted"](spark, SMALL))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        assert "l_returnflag" not in schema
    assert "orders.parquet" not in text and "part.parquet" not in text
