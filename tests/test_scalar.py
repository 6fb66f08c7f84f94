import numpy as np
import pytest
from pyspark.sql import functions as F

from retourlens.functions import scalar as s


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


@pytest.mark.parametrize(
    "digits, given, expected",
    [
        (2, [0.285, 0.575, 0.145, 1.005, 2.675], [0.28, 0.57, 0.14, 1.0, 2.68]),
        (0, [0.5, 1.5, 2.5], [0.0, 2.0, 2.0]),
        (3, [0.4945, -0.0001], [0.494, 0.0]),
    ],
)
def test_rounding(spark, digits, given, expected):
    got = values(spark, [(x,) for x in given], "x double", s.round_half_even("x", digits))
    assert [v for (v,) in got] == expected
    assert all(str(v) != "-0.0" for (v,) in got)


def test_texts(spark):
    rows = [("XL",), ("37+",), ("++",), (None,)]
    assert values(spark, rows, "x string", s.size_text("x")) == [("xl",), ("37.5",), (".5.5",), (None,)]
    rows = [("blau",), ("brwon",), ("oliv",), ("red",), (None,)]
    got = values(spark, rows, "x string", s.fix_colour("x"))
    assert got == [("blue",), ("brown",), ("olive",), ("red",), (None,)]
    rows = [("unsized",), ("xxxl",), ("37.5",), (None,)]
    assert values(spark, rows, "x string", s.size_number("x")) == [(0.0,), (7.0,), (37.5,), (None,)]
    rows = [("12",), ("",), ("3.5",), ("a1",), (None,)]
    got = values(spark, rows, "x string", s.is_digits("x"))
    assert got == [(True,), (False,), (False,), (False,), (None,)]


def test_bad_size_text_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, [("wide",)], "x string", s.size_number("x"))


def test_flag_fill_overwrite(spark):
    x = F.col("x")
    rows = [(1,), (-2,), (None,)]
    assert values(spark, rows, "x int", s.flag(x > 0)) == [(1,), (0,), (0,)]
    assert values(spark, rows, "x int", s.fill("x", 9)) == [(1,), (-2,), (9,)]
    assert values(spark, rows, "x int", s.overwrite_where("x", x < 0, -1)) == [(1,), (-1,), (None,)]


def test_grid_equals_numpy(spark):
    for start, stop, count in [(0.8, 1.7, 100), (0.98, 1.1, 100), (0.0, 1.0, 7)]:
        got = [r["m"] for r in s.linspace_df(spark, start, stop, count).orderBy("i").collect()]
        assert got == list(np.linspace(start, stop, num=count))
    assert s.linspace_ints(600, 900, 8) == [600, 642, 685, 728, 771, 814, 857, 900]


def test_dates(spark):
    rows = [("2020-01-02", "2020-03-01"), (None, "2020-03-01")]
    days = s.days_between(s.parse_date("a"), s.parse_date("b"))
    assert values(spark, rows, "a string, b string", days) == [(59,), (None,)]
    assert values(spark, [("no date",)], "a string", s.parse_date("a", strict=False)) == [(None,)]


def test_indicators_are_fixed(spark):
    made = s.indicator_columns("t", [1, 2, 3], "type")
    got = values(spark, [(2,), (None,)], "t int", *made.values())
    assert list(made) == ["type_1", "type_2", "type_3"] and got == [(0, 1, 0), (0, 0, 0)]
