"""Smoothed return rates per key and robust scaling per group."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retourlens.functions.scalar import round_half_even
from retourlens.operators.grouping import Form, GroupStep, Joined, Windowed, all_present, attach
from retourlens.operators.selection import SELECT_OVER, group_median
from retourlens.session import settle

# The rate of unsupported keys, and the MAD of a unit normal.
PRIOR = 0.48
NORMAL_MAD = 0.6744897501960817


@dataclass(frozen=True)
class TargetEncoder:
    """Share of returns per key, learnt from labelled rows only.

    A key with fewer than ``min_count`` labelled rows, or none, gets the prior.
    ``ratio_digits`` rounds the share before ``out_digits`` rounds the result.
    """

    keys: Sequence[str]
    output: str
    min_count: int
    label: str = "returned"
    prior: float = PRIOR
    ratio_digits: int | None = 3
    out_digits: int = 2

    def _rate(self, support: Column, returns: Column) -> Column:
        share = returns / F.nullif(support, F.lit(0))
        if self.ratio_digits is not None:
            share = round_half_even(share, self.ratio_digits)
        return F.when(support >= self.min_count, share).otherwise(F.lit(self.prior))

    def _finish(self, rate: Column) -> Column:
        # A null key: composite keys stay null, a single key is null for
        # labelled rows and counts as unseen for the others.
        usable = all_present(self.keys)
        if len(self.keys) == 1:
            usable = usable | F.col("is_unknown")
        value = F.coalesce(rate, F.lit(self.prior))
        return F.when(usable, round_half_even(value, self.out_digits))

    def unseen(self) -> Column:
        """The encoding of a key that was never counted."""
        return self._finish(F.lit(None).cast("double"))

    def from_sums(self, df: DataFrame, support: str, returns: str) -> DataFrame:
        """Encode rows that already carry their key's labelled rows and returns."""
        rate = self._rate(F.col(support), F.col(returns))
        return df.withColumn(self.output, self._finish(rate))

    def fit(self, known: DataFrame) -> DataFrame:
        """One row per key with its (unrounded by ``out_digits``) rate."""
        return (
            known.dropna(subset=list(self.keys))
            .groupBy(*self.keys)
            .agg(F.count(self.label).alias("__n"), F.sum(self.label).alias("__r"))
            .select(*self.keys, self._rate(F.col("__n"), F.col("__r")).alias(self.output))
        )

    def rates(self, sums: DataFrame, support: str, returns: str) -> DataFrame:
        """``fit`` of keys that are already counted."""
        return sums.select(*self.keys, self._rate(F.col(support), F.col(returns)).alias(self.output))

    def transform(self, df: DataFrame, encodings: DataFrame) -> DataFrame:
        """Needs ``is_unknown`` in ``df`` when the key is a single column."""
        found = attach(df, encodings, self.keys)
        return found.withColumn(self.output, self._finish(F.col(self.output)))

    def step(self, counted: tuple[str, str] | None = None) -> GroupStep:
        """Fit on the rows that are not ``is_unknown``, encode all of them.

        ``counted`` names columns of labelled rows and returns, for a frame
        whose rows stand for many.
        """
        label = F.when(~F.col("is_unknown"), F.col(self.label))
        support, returns = f"__{self.output}_n", f"__{self.output}_r"
        sums = (F.count(label), F.sum(label)) if counted is None else map(F.sum, counted)

        def finish(df: DataFrame) -> DataFrame:
            return self.from_sums(df, support, returns).drop(support, returns)

        return GroupStep(self.keys, dict(zip((support, returns), sums)), finish)

    def fit_transform(self, df: DataFrame, form: Form = Joined()) -> DataFrame:
        return self.step().run(df, form)


@dataclass(frozen=True)
class RobustScaler:
    """``(x - median) / MAD`` per group, 0 where the MAD is 0.

    The joined form reduces rows to counted distinct values, stored once, before
    it takes the medians; of groups with more than ``select_over`` values they
    are selected by nested histograms, so no task holds a group. ``weight`` names
    how many rows a row stands for, one if not given.
    """

    keys: Sequence[str]
    value: str
    output: str
    digits: int = 2
    weight: str | None = None
    select_over: int = SELECT_OVER

    def _scaled(self) -> Column:
        value, spread = F.col(self.value), F.col("__mad")
        scaled = round_half_even((value - F.col("__median")) / F.nullif(spread, F.lit(0.0)), self.digits)
        return F.when(value.isNotNull(), F.when(spread == 0, F.lit(0.0)).otherwise(scaled))

    def transform(self, df: DataFrame, form: Form = Joined()) -> DataFrame:
        away = F.abs(F.col(self.value) - F.col("__median"))
        if isinstance(form, Windowed):
            times = F.col(self.weight) if self.weight else F.lit(1)
            middle = F.percentile(self.value, F.lit(0.5), times)
            centred = form.values(df, self.keys, {"__median": middle})
            ready = form.values(centred, self.keys, {"__away": F.percentile(away, F.lit(0.5), times)})
        else:
            times = F.sum(self.weight) if self.weight else F.count("*")
            counted = form.rows(df).dropna(subset=[*self.keys, self.value])
            counted = counted.groupBy(*self.keys, F.col(self.value).alias("__value")).agg(times.alias("__n"))
            counted = settle(counted, "scaled-values")
            middle = settle(group_median(counted, self.keys, "__median", self.select_over), "medians")
            apart = attach(counted, middle, self.keys).withColumn("__value", F.abs(F.col("__value") - F.col("__median")))
            apart = apart.select(*self.keys, "__value", "__n")
            spread = attach(middle, group_median(apart, self.keys, "__away", self.select_over), self.keys)
            ready = attach(df, spread, self.keys)
        scaled = ready.withColumn("__mad", F.col("__away") / F.lit(NORMAL_MAD))
        return scaled.withColumn(self.output, self._scaled()).drop("__median", "__away", "__mad")
