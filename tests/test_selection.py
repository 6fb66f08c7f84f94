import random
import statistics

import pytest
from pyspark.sql import functions as F

from retourlens.operators.encoders import RobustScaler
from retourlens.operators.grouping import Windowed
from retourlens.operators.selection import group_median, order_key
from retourlens.session import settle


def test_keys_are_ordered_as_doubles(spark):
    values = [float("-inf"), -1e300, -2.5, -1.0, -5e-324, 0.0, 5e-324, 1e-9, 1.0, 1.0000000000000002, 3.0, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", order_key(F.col("v")).alias("k"))
    found = [r["k"] for r in df.collect()]
    assert found == sorted(found) and len(set(found)) == len(values)
    assert spark.range(1).select(order_key(F.lit(-0.0)) == order_key(F.lit(0.0))).first()[0]


@pytest.fixture(scope="module")
def groups():
    r = random.Random(3)
    return {
        (1, "a"): [r.gauss(0, 1) for _ in range(2001)], (1, "b"): [r.gauss(-5, 1e6) for _ in range(2000)],
        (2, "a"): [float(r.randrange(6)) for _ in range(900)], (2, "b"): [4.25], (3, "a"): [1.0, 2.0],
        (3, "b"): [r.choice([-1, 1]) * 10.0 ** r.randrange(-300, 300) for _ in range(700)],
        (4, "a"): [7.0] * 500, (5, "a"): [1.0 + n * 2.0**-52 for n in range(64)],
    }


@pytest.mark.parametrize("over, bits", [(0, 11), (0, 3), (50, 16), (10**6, 11)])
def test_medians_equal_a_plain_sort(spark, groups, over, bits):
    rows = [(*k, v, 1) for k, values in groups.items() for v in values] + [(None, "a", 1.0, 1), (1, "a", None, 5), (9, "z", None, 1)]
    table = spark.createDataFrame(rows, "g int, h string, __value double, __n long")
    found = {(r["g"], r["h"]): r["m"] for r in group_median(settle(table, "values"), ["g", "h"], "m", over, bits).collect()}
    assert found == pytest.approx({k: statistics.median(v) for k, v in groups.items()}, rel=1e-15)


def test_counted_values(spark):
    rows = [(1, 5.0, 3), (1, 6.0, 2), (1, 6.0, 1), (2, -1.0, 10), (2, 8.0, 9)]
    table = spark.createDataFrame(rows, "g int, __value double, __n long")
    assert {r["g"]: r["m"] for r in group_median(table, ["g"], "m", over=0).collect()} == {1: 5.5, 2: -1.0}


def test_scaler_forms_agree(spark, groups):
    rows = [(f"{k}", v) for k, values in groups.items() for v in values if abs(v) < 1e9] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    results = [
        sorted(tuple(r) for r in RobustScaler(["g"], "v", "v2", select_over=over).transform(df, *form).fillna(-99.0).collect())
        for over, form in ((0, ()), (10**6, ()), (0, (Windowed(),)))
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) == len(rows)


def test_no_level_holds_a_group(spark):
    """A group of a million different values: what moves per level is a row a bucket and task."""
    table = settle(spark.range(1_000_000, numPartitions=4).select(F.lit(1).alias("g"), (F.hash("id") / 7).alias("__value"), F.lit(1).cast("long").alias("__n")), "million")
    found = group_median(table, ["g"], "m", over=1000).first()["m"]
    assert found == table.agg(F.percentile("__value", F.lit(0.5))).first()[0]
