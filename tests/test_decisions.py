import random

import numpy as np
import pytest

from retourlens.operators import decisions as d
from retourlens.operators.tables import best_rows

SCHEMA = "returned int, item_price double, score double"


def test_tau(spark):
    df = spark.createDataFrame([(0.0,), (30.0,), (100.0,)], "item_price double")
    got = [r["tau"] for r in d.with_tau(df).orderBy("item_price").collect()]
    assert got == [0, 0.5, pytest.approx(0.606061, abs=1e-6)]


def test_costs_that_cancel_out(spark):
    """At a price of -10 no score is the break-even point, so there is no warning."""
    df = spark.createDataFrame([(1, -10.0, 0.9), (0, -10.0, -1.0), (1, 30.0, 0.9)], SCHEMA)
    assert sorted((r["item_price"], r["tau"], r["warn"]) for r in d.warn(df).collect()) == sorted(
        [(-10.0, None, 0), (-10.0, None, 0), (30.0, 0.5, 1)], key=lambda t: t[0]
    )
    assert d.revenue_sweep(df).count() == 100


def test_every_prediction_is_decided(spark):
    priced = spark.createDataFrame([(1, 30.0)], "order_item_id long, item_price double")
    scores = spark.createDataFrame([(1, 0.9), (2, 0.9)], "order_item_id long, score double")
    assert sorted(map(tuple, d.decide(priced, scores).collect())) == [(1, 1), (2, 0)]


def test_four_outcomes(spark):
    rows = [(1, 0.4), (0, 0.5), (1, 0.6), (0, 0.4)]
    df = spark.createDataFrame([(y, 30.0, s) for y, s in rows], SCHEMA)
    decided = d.error_cost(d.revenue(d.warn(df)))
    got = {(r["returned"], r["warn"]): (r["error_cost"], r["revenue"]) for r in decided.collect()}
    assert got == {(1, 0): (-15, -15), (0, 1): (-15, -15), (1, 1): (0, 0), (0, 0): (0, 30)}
    summary = d.cost_summary(decided).first()
    assert (summary["n_warned"], summary["total_revenue"], summary["total_cost"]) == (2, 0, -30)


def test_unscored_row_is_not_warned(spark):
    df = spark.createDataFrame([(1, 30.0, None)], SCHEMA)
    assert d.warn(df).first()["warn"] == 0


def brute(rows, metric, grid):
    totals = []
    for m in grid:
        total = 0.0
        for y, p, s in rows:
            keep, miss, lost = p, 2.5 * -(3 + 0.1 * p), 0.5 * -p
            tau = lost / (lost + miss)
            warned = int(s is not None and tau * m <= s)
            if y > warned:
                total += miss
            elif warned > y:
                total += lost
            elif not warned and metric == "revenue":
                total += keep
        totals.append(round(total, 2))
    return totals


@pytest.mark.parametrize("metric", ["revenue", "error_cost"])
def test_sweep_equals_every_grid_point(spark, metric):
    draw = random.Random(5)
    start, stop, count = 0.8, 1.7, 100
    grid = list(np.linspace(start, stop, num=count))
    rows = [(draw.randint(0, 1), float(draw.randint(0, 120)), round(draw.random(), 2)) for _ in range(300)]
    # Scores exactly on a grid point's threshold, free items, refunds, no score.
    for m in grid[::7]:
        p = float(draw.randint(1, 100))
        tau = 0.5 * -p / (0.5 * -p + 2.5 * -(3 + 0.1 * p))
        rows.append((1, p, float(tau * m)))
    rows += [(0, 0.0, 0.0), (1, 0.0, -0.5), (0, -5.0, -0.6), (1, -5.0, -0.9), (1, 20.0, None)]
    got = d.sweep(spark.createDataFrame(rows, SCHEMA), metric, start, stop, count).orderBy("i").collect()
    assert [r["m"] for r in got] == grid
    assert [r[metric] for r in got] == pytest.approx(brute(rows, metric, grid), abs=0.011)


def test_sweep_at_one_equals_summary(spark):
    draw = random.Random(6)
    rows = [(draw.randint(0, 1), float(draw.randint(1, 90)), draw.random()) for _ in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    swept = d.sweep(df, "revenue", 1.0, 2.0, 2).where("i = 0").first()["revenue"]
    assert swept == pytest.approx(d.cost_summary(d.warn(df)).first()["total_revenue"], abs=0.01)


def test_warnings_fall_as_the_multiplier_rises(spark):
    rows = [(i % 2, float(i % 90 + 1), i / 200) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    counts = [d.warn(df, m).where("warn = 1").count() for m in (0.5, 1.0, 1.5, 3.0)]
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[-1]


def test_best_rows_keeps_ties(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 5.0), (3, 5.0)], "i int, v double")
    assert {r["i"] for r in best_rows(df, "v").collect()} == {2, 3}


def test_decide(spark):
    prices = spark.createDataFrame([(1, 30.0), (2, 30.0)], "order_item_id long, item_price double")
    scores = spark.createDataFrame([(2, 0.7), (1, 0.2)], "order_item_id long, score double")
    assert {tuple(r) for r in d.decide(prices, scores).collect()} == {(1, 0), (2, 1)}


def test_confusion_cells(spark):
    df = spark.createDataFrame([(1, 30.0, 0.1), (0, 30.0, 0.1), (0, 30.0, 0.2)], SCHEMA)
    got = {(r["returned"], r["warn"]): r["n_rows"] for r in d.confusion(d.warn(df)).collect()}
    assert got == {(1, 0): 1, (0, 0): 2}
