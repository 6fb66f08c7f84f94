"""Values of a row's group, in a form that survives hot keys.

Two forms of every group value exist. ``Windowed`` shuffles the rows once by
the group key and needs no join, but puts a whole group into one task.
``Joined`` aggregates with map-side combine and joins the result back, so no
task ever sees a whole group and Spark may split a skewed join. ``per_group``
picks the first for groups that are small enough and the second for the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retourlens.session import settle

MAX_GROUP_ROWS = 2_000_000


def all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def attach(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()
) -> DataFrame:
    """Left join of a table with one row per key; a null key finds nothing,
    except in the ``null_safe`` columns, where it finds the null's own row.

    There is no broadcast hint: Spark broadcasts by the measured size, and
    splits skewed partitions of ``df`` otherwise.
    """
    renamed = lookup.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    pairs = [(k, F.col(k), F.col(f"__key_{k}")) for k in keys]
    same = reduce(and_, [a.eqNullSafe(b) if k in null_safe else a == b for k, a, b in pairs])
    return df.join(renamed, same, "left").drop(*[f"__key_{k}" for k in keys])


@dataclass(frozen=True)
class Windowed:
    """Group values by window functions over rows shuffled by their key."""

    def prepare(self, step: Callable[[DataFrame], DataFrame]) -> Windowed:
        return self

    def values(self, df: DataFrame, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
        group, present = Window.partitionBy(*keys), all_present(keys)
        return df.withColumns({n: F.when(present, v.over(group)) for n, v in values.items()})

    def days_since_previous(
        self, df: DataFrame, keys: Sequence[str], date: str, default: int, name: str
    ) -> DataFrame:
        # SQL text: the frame bound must be an int on a date, the API sends a long.
        previous = F.expr(
            f"max({date}) over (partition by {', '.join(keys)} order by {date} "
            "range between unbounded preceding and 1 preceding)"
        )
        gap = F.coalesce(F.datediff(F.col(date), previous), F.lit(default))
        return df.withColumn(name, F.when(all_present([*keys, date]), gap))


@dataclass(frozen=True)
class Absent(Windowed):
    """The form for rows without a key: every group value is null, nothing moves."""

    def values(self, df: DataFrame, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
        kinds = df.groupBy().agg(*[v.alias(n) for n, v in values.items()]).schema
        return df.withColumns({k.name: F.lit(None).cast(k.dataType) for k in kinds})

    def days_since_previous(
        self, df: DataFrame, keys: Sequence[str], date: str, default: int, name: str
    ) -> DataFrame:
        return df.withColumn(name, F.lit(None).cast("int"))


@dataclass(frozen=True)
class Joined:
    """Group values by aggregation and a join back.

    ``source`` holds the same groups as the frame they are added to, without
    the columns added so far; a chain of steps that aggregate it stays linear
    in size, where each step reading its predecessor's output would double.
    """

    source: DataFrame | None = None

    def rows(self, df: DataFrame) -> DataFrame:
        return df if self.source is None else self.source

    def prepare(self, step: Callable[[DataFrame], DataFrame]) -> Joined:
        return self if self.source is None else Joined(step(self.source))

    def values(self, df: DataFrame, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
        rows = self.rows(df).dropna(subset=list(keys))
        return attach(df, rows.groupBy(*keys).agg(*[v.alias(n) for n, v in values.items()]), keys)

    def days_since_previous(
        self, df: DataFrame, keys: Sequence[str], date: str, default: int, name: str
    ) -> DataFrame:
        """Windows over distinct dates: a key has no more of them than the
        calendar has, however many rows it has."""
        dates = self.rows(df).select(*keys, date).dropna().distinct()
        previous = F.lag(date).over(Window.partitionBy(*keys).orderBy(date))
        gap = F.coalesce(F.datediff(F.col(date), previous), F.lit(default))
        return attach(df, dates.withColumn(name, gap), [*keys, date])


Form = Windowed | Joined


@dataclass(frozen=True)
class GroupStep:
    """Aggregates of a row's group, and what to make of them."""

    keys: Sequence[str]
    values: dict[str, Column]
    finish: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)

    def run(self, df: DataFrame, form: Form) -> DataFrame:
        return run_steps(df, [self], form)


def run_steps(df: DataFrame, steps: Sequence[GroupStep], form: Form) -> DataFrame:
    """All steps; those with equal keys share one pass over their groups."""
    by_keys: dict[tuple[str, ...], list[GroupStep]] = {}
    for step in steps:
        by_keys.setdefault(tuple(step.keys), []).append(step)
    for keys, group in by_keys.items():
        df = form.values(df, keys, {n: v for step in group for n, v in step.values.items()})
        for step in group:
            df = step.finish(df)
    return df


def hot_keys(df: DataFrame, key: str, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Keys with more rows than one task should hold; at most rows / max_rows.

    Null is among them where so many rows have no key.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("rows"))
    return counts.where(F.col("rows") > max_rows).select(key)


def per_group(
    df: DataFrame,
    key: str,
    build: Callable[[DataFrame, Form], DataFrame],
    hot: DataFrame,
    source: DataFrame | None = None,
) -> DataFrame:
    """``build(rows, form)`` over all rows: joined for the ``hot`` keys, which
    should be a settled table, windowed for the others. If null is hot, rows
    without a key are built apart, without a shuffle.

    ``source`` is what the joined form aggregates, ``df`` itself if not given.
    Its hot rows are written out once, since every aggregate reads them anew;
    so is a ``df`` beside a source, which the split would work out twice.
    """
    if hot.isEmpty():
        return build(df, Windowed())
    if not hot.where(F.col(key).isNull()).isEmpty():
        keyed, others = F.col(key).isNotNull(), hot.dropna()
        apart = build(df.where(~keyed), Absent())
        return per_group(df.where(keyed), key, build, others, source).unionByName(apart)
    rows = df if source is None else source
    if source is not None:
        df = settle(df, f"rows-before-{key}")
    crowd = settle(rows.join(hot, key, "left_semi"), f"rows-of-hot-{key}")
    small = build(df.join(hot, key, "left_anti"), Windowed())
    large = build(crowd if source is None else df.join(hot, key, "left_semi"), Joined(crowd))
    return small.unionByName(large)
