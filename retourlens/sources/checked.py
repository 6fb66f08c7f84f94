"""Files whose types are not known, or whose rows can't all be trusted.

``infer_schema`` finds the narrowest types that all values of a csv fit, and
``differences`` holds them against a declared schema. ``read_checked`` reads by
a declared schema without stopping at a bad row: rows that fit come out typed,
the others go to a table of their own with file, reasons and text. Reading by
``sources.orders`` remains the fail-fast way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT, _FILE = "__corrupt", "__file"
#: Types by rising width; a column gets the first one that all its values fit.
INFERRED = [T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(), T.BooleanType(), T.StringType()]
#: Rows that are tested for all types before all rows are tested for the types that are left.
HEAD_ROWS = 1000
#: Pairs of an inferred type and a wider one that may be declared for it.
_WIDER = {("int", "bigint"), ("int", "double"), ("bigint", "double")}
# What Java reads as a number, and no less: a failed cast raises inside, which takes far longer than this test.
_NUMBER = r"(?i)^[\x00-\x20]*[+-]?([0-9.]+(e[+-]?[0-9]+)?[fd]?|0x[0-9a-f.]*p[+-]?[0-9]+[fd]?|nan|inf(inity)?)[\x00-\x20]*$"


def typed(text: Column, kind: T.DataType) -> Column:
    """A text as a value of the type, null if it is none. Dates are written year-month-day."""
    if isinstance(kind, T.StringType):
        return text
    value = text.try_cast(kind)
    if isinstance(kind, T.DateType):
        return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), value)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return F.when(text.rlike(r"^[+-]?[0-9]+$"), value)
    if isinstance(kind, T.DoubleType):
        return F.when(text.rlike(_NUMBER), value)
    return value


def _texts(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """All columns as texts, with the line itself where it has too many or too few of them, and its file."""
    fields = [T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]]
    reader = spark.read.schema(T.StructType(fields)).option("header", True).option("enforceSchema", False)
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
    return rows.withColumn(_FILE, F.col("_metadata.file_path"))


def infer_schema(spark: SparkSession, path: str) -> T.StructType:
    """Narrowest types of a csv with a header, from all its rows in one scan after a look at the first.

    A column without a value is a string, one with a gap or with an empty text
    nullable. Unlike a reader's own inference it never decides by a sample, and
    int, long, double, date and boolean are told apart by the same rules by
    which ``read_checked`` reads.
    """
    names = spark.read.option("header", True).csv(path).columns
    rows = _texts(spark, path, names).where(F.col(_CORRUPT).isNull())
    # A type that one value does not fit is out; the first rows spare the others most of the tests.
    first = _fits(rows.limit(HEAD_ROWS), dict.fromkeys(names, INFERRED[:-1]))
    left = {n: [kind for kind, fit in zip(INFERRED, fits) if fit] for n, (_, _, fits) in first.items()}
    fields = []
    for name, (values, gaps, fits) in _fits(rows, left).items():
        kind = next((k for k, fit in zip(left[name], fits) if fit and values), INFERRED[-1])
        fields.append(T.StructField(name, kind, nullable=bool(gaps or not values)))
    return T.StructType(fields)


def _fits(rows: DataFrame, kinds: dict[str, list[T.DataType]]) -> dict[str, tuple[int, int, list[bool]]]:
    """Of each column how many values and gaps it has, and whether all values fit each of its ``kinds``."""
    checks = []
    for name, tried in kinds.items():
        text = F.col(f"`{name}`")
        checks += [F.count(text), F.count_if(text.isNull())]
        fine = text.isNull()
        for kind in tried:
            fits = typed(text, kind).isNotNull()
            # What fits a whole number fits the wider ones, which are tested only where it does not.
            whole = isinstance(kind, (T.IntegerType, T.LongType, T.DoubleType))
            checks.append(F.bool_and(fine | fits if whole else text.isNull() | fits))
            fine = fine | fits if whole else fine
    found, at, out = list(rows.agg(*checks).first()), 0, {}
    for name, tried in kinds.items():
        end = at + 2 + len(tried)
        out[name] = (found[at], found[at + 1], found[at + 2 : end])
        at = end
    return out


def differences(inferred: T.StructType, declared: T.StructType) -> list[str]:
    """In words, where values would not fit the declared schema; empty if all do."""
    own, found = {f.name: f for f in inferred}, []
    for field in declared:
        seen = own.pop(field.name, None)
        if seen is None:
            found.append(f"{field.name}: not in the file")
            continue
        pair = (seen.dataType.simpleString(), field.dataType.simpleString())
        if pair[0] != pair[1] and pair not in _WIDER and pair[1] != "string":
            found.append(f"{field.name}: {pair[0]} in the file, {pair[1]} declared")
        if seen.nullable and not field.nullable:
            found.append(f"{field.name}: gaps in the file, none declared")
    return found + [f"{name}: not declared" for name in own]


@dataclass(frozen=True)
class Checked:
    """``rows`` by the declared schema, and ``rejected`` (file, reasons, line)."""

    rows: DataFrame
    rejected: DataFrame


def read_checked(spark: SparkSession, path: str, schema: T.StructType) -> Checked:
    """Rows of a csv that fit ``schema``, and those that don't.

    Reasons are ``malformed line`` for one with too many or too few values, and
    per column ``name: not a bigint`` and ``name: missing`` for a gap where none
    is allowed. ``line`` is the malformed line, or the row's values as JSON. A
    header that differs from the schema is an error, as it concerns all rows.
    Both tables are lazy scans of the same file; no row is in both or in none.
    """
    rows = _texts(spark, path, schema.names)
    reasons = [F.when(F.col(_CORRUPT).isNotNull(), F.lit("malformed line"))]
    for field in schema:
        text, fine = F.col(f"`{field.name}`"), F.col(_CORRUPT).isNull()
        reasons.append(F.when(fine & text.isNotNull() & typed(text, field.dataType).isNull(), f"{field.name}: not a {field.dataType.simpleString()}"))
        if not field.nullable:
            reasons.append(F.when(fine & text.isNull(), f"{field.name}: missing"))
    judged = rows.withColumn("__reasons", F.array_compact(F.array(*reasons)))
    values = [typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema]
    line = F.coalesce(F.col(_CORRUPT), F.to_json(F.struct(*[F.col(f"`{n}`") for n in schema.names])))
    return Checked(
        judged.where(F.size("__reasons") == 0).select(*values),
        judged.where(F.size("__reasons") > 0).select(F.col(_FILE).alias("file"), F.col("__reasons").alias("reasons"), line.alias("line")),
    )
