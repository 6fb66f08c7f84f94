"""Order items as a view over lineitem, orders, customer and part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the adapter view.
COLOURS = ["blau", "brwon", "oliv", "blue", "brown", "olive", "black", "?"]
LETTERS = ["XS", "s", "M", "l", "XL", "xxl", "XXXL"]

# Declared, so that opening a table starts no job to infer its columns.
_TABLES = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "customer": "c_custkey long",
    "part": "p_partkey long, p_brand string",
}
_FROM_ORDERS = {"order_date", "user_id"}
_FROM_PART = {"brand_id"}
_FROM_CUSTOMER = {"user_dob", "user_reg_date"}


def _size() -> Column:
    line, kind = F.col("l_linenumber"), F.col("l_partkey") % 7
    plus = F.when(F.col("l_quantity").cast("int") % 2 == 1, F.lit("+")).otherwise(F.lit(""))
    return (
        F.when(kind == 0, F.concat((line + 36).cast("string"), plus))
        .when(kind == 1, F.elt(line, *[F.lit(x) for x in LETTERS]))
        .when(kind == 2, (line * 2).cast("string"))
        .when(kind == 3, (line * 32 + 3000).cast("string"))
        .when(kind == 4, (line * 6 + 86).cast("string"))
        .when(kind == 5, (line + 30).cast("string"))
        .otherwise(F.lit("unsized"))
    )


def _colour() -> Column:
    return F.elt((F.col("l_suppkey") % 8 + 1).cast("int"), *[F.lit(x) for x in COLOURS])


def _order_item_id() -> Column:
    # 100 ids are set aside per order, so a window over one order stays small.
    in_order = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_shipdate", "l_quantity", "l_discount", "l_tax",
    )
    return F.row_number().over(in_order) + F.col("l_orderkey") * 100


def _unknown() -> Column:
    return F.col("l_orderkey") % 3 == 0


def _user_dob() -> Column:
    days = (F.col("c_custkey") * 37 % 18000).cast("int")
    return F.when(F.col("c_custkey") % 11 != 0, F.date_add(F.lit("1940-01-01").cast("date"), days))


def _brand_id() -> Column:
    return F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).cast("long")


def _user_reg_date() -> Column:
    days = (F.col("c_custkey") * 13 % 900).cast("int")
    return F.date_add(F.lit("1994-06-01").cast("date"), days)


_COLUMNS = {
    "order_item_id": _order_item_id,
    "is_unknown": _unknown,
    "order_date": lambda: F.col("o_orderdate").cast("date"),
    "delivery_date": lambda: F.when(F.col("l_tax") != 0, F.col("l_shipdate").cast("date")),
    "item_id": lambda: F.col("l_partkey"),
    "item_size": _size,
    "item_color": _colour,
    "brand_id": lambda: F.col("brand_id"),
    "item_price": lambda: F.col("l_extendedprice") / 1000,
    "user_id": lambda: F.col("o_custkey"),
    "user_dob": lambda: F.col("user_dob"),
    "user_reg_date": lambda: F.col("user_reg_date"),
    "returned": lambda: F.when(~_unknown(), (F.col("l_returnflag") == "R").cast("int")),
}


def _broadcast_by_spark(df: DataFrame) -> bool:
    """Whether Spark's own estimate of a table is within its broadcast threshold."""
    plan = df._jdf.queryExecution()
    limit = plan.sparkSession().sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(plan.optimizedPlan().stats().sizeInBytes())) <= limit


def sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named columns of the view, or all of them.

    Every lineitem has its order, customer and part, so a table none of whose
    columns is asked for is not joined at all.
    """
    wanted = list(columns) or list(_COLUMNS)

    def table(name: str) -> DataFrame:
        return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    # Line items move to their order last, so that ids are numbered where they lie.
    # What follows from a part or a customer is worked out on that side, on fewer
    # and narrower rows. Customers that Spark broadcasts are joined last, where
    # nothing moves for them; others to the orders, of which there are fewer.
    rows = table("lineitem")
    if _FROM_PART.intersection(wanted):
        part = table("part").select("p_partkey", _brand_id().alias("brand_id"))
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"))
    in_order, of_customer = F.col("l_orderkey") == F.col("o_orderkey"), F.col("o_custkey") == F.col("c_custkey")
    if _FROM_CUSTOMER.intersection(wanted):
        customer = table("customer").select("c_custkey", _user_dob().alias("user_dob"), _user_reg_date().alias("user_reg_date"))
        if _broadcast_by_spark(customer):
            rows = rows.join(table("orders"), in_order).join(customer, of_customer)
        else:
            rows = rows.join(table("orders").join(customer, of_customer), in_order)
    elif _FROM_ORDERS.intersection(wanted):
        rows = rows.join(table("orders"), in_order)
    return rows.select(*[_COLUMNS[c]().alias(c) for c in wanted])
