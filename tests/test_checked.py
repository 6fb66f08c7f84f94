import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retourlens.sources import checked
from retourlens.sources.checked import _NUMBER, differences, infer_schema, read_checked, typed
from retourlens.sources.orders import UNLABELLED_SCHEMA

HEADER = "id,day,price,name,flag,big\n"
SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False), T.StructField("day", T.DateType()), T.StructField("price", T.DoubleType()),
    T.StructField("name", T.StringType()), T.StructField("flag", T.BooleanType()), T.StructField("big", T.LongType()),
])
GOOD = ["1,2020-01-31,2.5,a,true,5000000000", '2,,3,"b,c",false,', "3,2020-02-29,1e3,,true,7"]
BAD = [
    "x,2020-01-01,1,a,true,1", ",2020-01-01,1,a,true,1", "4,2020-02-30,1,a,true,1", "5,2020-1-1,1,a,true,1", "6,2020-01-01,cheap,a,maybe,1.5",
    "7,2020-01-01,1,a,true,1,more", "8,2020-01-01",
]


@pytest.fixture
def files(tmp_path):
    (tmp_path / "one.csv").write_text(HEADER + "\n".join(GOOD) + "\n")
    (tmp_path / "two.csv").write_text(HEADER + "\n".join(BAD) + "\n")
    return tmp_path


def test_bad_rows_are_set_apart(spark, files):
    found = read_checked(spark, str(files), SCHEMA)
    assert found.rows.schema.simpleString() == SCHEMA.simpleString()
    assert sorted(r["id"] for r in found.rows.collect()) == [1, 2, 3]
    assert {r["id"]: (r["name"], r["big"]) for r in found.rows.collect()}[2] == ("b,c", None)
    rejected = found.rejected.collect()
    assert len(rejected) == len(BAD) and all(r["file"].endswith("two.csv") and r["line"] for r in rejected)
    assert sorted(tuple(r["reasons"]) for r in rejected) == sorted([
        ("id: not a bigint",), ("id: missing",), ("day: not a date",), ("day: not a date",),
        ("price: not a double", "flag: not a boolean", "big: not a bigint"), ("malformed line",), ("malformed line",),
    ])


def test_types_come_from_all_rows(spark, files):
    good = infer_schema(spark, str(files / "one.csv"))
    assert good.simpleString() == "struct<id:int,day:date,price:double,name:string,flag:boolean,big:bigint>"
    assert [f.nullable for f in good] == [False, True, False, True, False, True]
    assert differences(good, SCHEMA) == []
    both = infer_schema(spark, str(files))
    assert both.simpleString() == "struct<id:string,day:string,price:string,name:string,flag:string,big:double>"
    assert differences(both, SCHEMA) == [
        "id: string in the file, bigint declared", "id: gaps in the file, none declared", "day: string in the file, date declared",
        "price: string in the file, double declared", "flag: string in the file, boolean declared", "big: double in the file, bigint declared",
    ]


def test_names_that_differ(spark, files):
    other = T.StructType([*SCHEMA[:-1], T.StructField("amount", T.LongType())])
    assert differences(infer_schema(spark, str(files / "one.csv")), other) == ["amount: not in the file", "big: not declared"]
    with pytest.raises(Exception):
        read_checked(spark, str(files), other).rows.collect()
    assert UNLABELLED_SCHEMA.names[0] == "order_item_id"


def test_no_rows(spark, tmp_path):
    (tmp_path / "none.csv").write_text(HEADER)
    found = read_checked(spark, str(tmp_path), SCHEMA)
    assert found.rows.count() == 0 and found.rejected.count() == 0
    assert set(f.dataType for f in infer_schema(spark, str(tmp_path))) == {T.StringType()}


def test_numbers_are_tested_before_they_are_cast(spark):
    """The test lets through all that a cast accepts, and keeps dates and words from it."""
    texts = ["1", "-1.5", "+.5", "5.", "1e3", "1E-3", "2d", "3.5F", " 7 ", "\t8", "NaN", "nan", "Infinity", "-inf", "+INF", "0x1p3", "-0X1.8p-1D",
             "", " ", ".", "1e", "1996-02-30", "blue", "1,5", "0x1", "1_0", "d", "--1", "infinite"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    value = typed(F.col("t"), T.DoubleType())
    got = rows.select(value.cast("string"), F.col("t").try_cast("double").cast("string")).collect()
    assert [r[0] for r in got] == [r[1] for r in got] and sum(r[0] is not None for r in got) == 17
    assert "RLIKE" in str(value).upper()
    assert not rows.where("t in ('1996-02-30', 'blue', '1,5', '')").where(F.col("t").rlike(_NUMBER)).count()


def test_later_values_widen_what_the_first_rows_leave(spark, tmp_path, monkeypatch):
    """First rows only spare tests; every value of every row still decides."""
    passes = []
    fits = checked._fits
    monkeypatch.setattr(checked, "HEAD_ROWS", 1)
    monkeypatch.setattr(checked, "_fits", lambda rows, kinds: passes.append(kinds) or fits(rows, kinds))
    lines = ["1,1,1,1,,2020-01-01,a,true,7", "2,5000000000,2.5,x,3,2020-01-02,,false,5000000000", "3,2,1e3,4,4,x,b,maybe,1.5", ",,,,,,,,"]
    (tmp_path / "one.csv").write_text("i,l,d,s,late,day,name,flag,wide\n" + "\n".join(lines) + "\n")
    found = infer_schema(spark, str(tmp_path))
    assert found.simpleString() == "struct<i:int,l:bigint,d:double,s:string,late:int,day:string,name:string,flag:string,wide:double>"
    assert all(f.nullable for f in found)
    names = {n: [k.simpleString() for k in kinds] for n, kinds in passes[1].items()}
    assert len(passes) == 2 and names["name"] == [] and names["day"] == ["date"] and names["flag"] == ["boolean"]
