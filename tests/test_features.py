from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from retourlens.operators import features as f
from retourlens.operators.encoders import RobustScaler, TargetEncoder
from retourlens.operators.grouping import Joined, Windowed, hot_keys, per_group
from retourlens.session import settle

FORMS = [Windowed(), Joined()]


def by_id(df, *columns):
    return [tuple(r) for r in df.orderBy("id").select(*columns).collect()]


@pytest.mark.parametrize("form", FORMS)
def test_days_since_previous(spark, form):
    days = [1, 1, 5, 5, 6]
    rows = [(i, 7, 3, date(2020, 1, d)) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "id int, user_id long, item_id long, order_date date")
    assert by_id(f.latest_order(df, form), "latest_order") == [(-1,), (-1,), (4,), (4,), (1,)]
    got = by_id(f.ordered_item_recently(df, form), "ordered_item_recently")
    assert got == [(0,), (0,), (4,), (4,), (1,)]


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize(
    "sizes, expected",
    [
        (["37.5", "38"], 1), (["xs", "m"], 2), (["2", "14"], 3), (["3032", "3224"], 4),
        (["92", "128"], 5), (["31", "37"], 6), (["unsized"], 7), (["unsized", "m"], 2),
        ([None, "unsized"], 7), ([None], 2),
    ],
)
def test_item_type(spark, form, sizes, expected):
    df = spark.createDataFrame([(1, s) for s in sizes], "item_id long, item_size string")
    assert {r["type"] for r in f.classify_items(df, form).collect()} == {expected}


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize(
    "values, expected",
    [
        ([1.0, 2.0, 4.0, 9.0], [-0.9, -0.45, 0.45, 2.7]),
        ([5.0, 5.0, 5.0, 9.0], [0.0] * 4),
        ([1.0, None, 3.0, None], [-0.67, None, 0.67, None]),
    ],
)
def test_robust_scaling(spark, form, values, expected):
    df = spark.createDataFrame([(i, 1, v) for i, v in enumerate(values)], "id int, k int, v double")
    got = by_id(RobustScaler(["k"], "v", "v").transform(df, form), "v")
    assert [v for (v,) in got] == expected


@pytest.mark.parametrize("form", FORMS)
def test_encoder_rules(spark, form):
    rows = [("a", False, int(i < 49)) for i in range(99)]
    rows += [("b", False, 1)] * 98 + [("c", True, None), ("a", True, None)]
    rows += [(None, False, 1), (None, True, None)]
    df = spark.createDataFrame(rows, "k string, is_unknown boolean, returned int")
    encoded = TargetEncoder(["k"], "rate", 99).fit_transform(df, form)
    got = {(r["k"], r["is_unknown"]): r["rate"] for r in encoded.distinct().collect()}
    assert got == {
        ("a", False): 0.5, ("a", True): 0.5, ("b", False): 0.48, ("c", True): 0.48,
        (None, False): None, (None, True): 0.48,
    }
    one_step = TargetEncoder(["k"], "rate", 99, ratio_digits=None).fit_transform(df, form)
    assert {r["rate"] for r in one_step.where("k = 'a'").collect()} == {0.49}


@pytest.mark.parametrize("form", FORMS)
def test_composite_null_key_stays_null(spark, form):
    rows = [(1, None, False, 1), (1, None, True, None), (1, "x", True, None)]
    df = spark.createDataFrame(rows, "a int, b string, is_unknown boolean, returned int")
    encoded = TargetEncoder(["a", "b"], "rate", 1, ratio_digits=None).fit_transform(df, form)
    assert [r["rate"] for r in encoded.orderBy("b", "is_unknown").collect()] == [None, None, 0.48]


def test_fit_then_transform_equals_one_pass(spark):
    rows = [(i % 7, i % 3 == 0, i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, is_unknown boolean, returned int")
    encoder = TargetEncoder(["k"], "rate", 15)
    two = encoder.transform(df, encoder.fit(df.where("not is_unknown")))
    assert sorted(two.collect()) == sorted(encoder.fit_transform(df, Windowed()).select(*two.columns).collect())


@pytest.mark.parametrize("form", FORMS)
def test_counts_and_discount(spark, form):
    rows = [(0, 1, 5, "red", 10.0), (1, 1, 5, "blue", 20.0), (2, 2, 5, "red", 15.0), (3, 1, 6, "red", 3.0)]
    df = spark.createDataFrame(rows, "id int, user_id long, item_id long, item_color string, item_price double")
    df = df.withColumn("order_date", F.lit("2020-01-01").cast("date"))
    out = f.new_user(f.count_user(f.customer_value(df, form), form))
    assert by_id(out, "customer_value", "count_user", "new_user") == [
        (33.0, 3, 0), (33.0, 3, 0), (15.0, 1, 1), (33.0, 3, 0)
    ]
    assert by_id(f.count_item_user(df, form), "count_item_user") == [(2,), (2,), (1,), (1,)]
    assert by_id(f.multi_colour_per_day(df, form), "multi_colour_per_day") == [(1,)] * 4
    assert by_id(f.orders_per_day(df, form), "orders_per_day") == [(3,), (3,), (1,), (3,)]
    # Mean price 15: only the cheaper row counts, an equal price does not.
    assert by_id(f.is_discounted(df, form), "is_discounted") == [(1,), (0,), (0,), (0,)]


def test_date_features(spark):
    start = date(2020, 6, 1)
    rows = [
        (0, start, start + timedelta(1), start - timedelta(4), None),
        (1, start, start + timedelta(2), None, start - timedelta(3650)),
        (2, start, start - timedelta(3), start, start - timedelta(365 * 20 + 200)),
    ]
    schema = "id int, order_date date, user_reg_date date, delivery_date date, user_dob date"
    df = spark.createDataFrame(rows, schema)
    out = f.assumed_age(f.time_to_delivery(f.membership_age(f.was_delivered(df))))
    got = by_id(out, "membership_age_days", "time_to_delivery_days", "was_delivered", "assumed_age")
    assert got == [(0, -1, 1, 0.0), (-2, 9999, 0, 10.0), (3, 0, 1, 21.0)]


def test_hot_groups_give_the_same_values(spark):
    """A third of all rows in one group: joined for it, windowed for the rest."""
    rows = [(i, 1 if i % 3 == 0 else i % 50, i % 4, i % 2 == 0, i % 5 % 2) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, user_id long, d int, is_unknown boolean, returned int")
    df = df.withColumn("order_date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d")))
    hot = settle(hot_keys(df, "user_id", 100), "hot")
    assert [r["user_id"] for r in hot.collect()] == [1]

    def build(rows, form):
        return f.user_encoder().fit_transform(f.latest_order(f.count_user(rows, form), form), form)

    columns = ["id", "count_user", "latest_order", "ce_user"]
    both = by_id(per_group(df, "user_id", build, hot), *columns)
    assert both == by_id(build(df, Windowed()), *columns) == by_id(build(df, Joined()), *columns)
