"""Outliers by what is usual in the data: a window of days, and bounds of amounts.

Both come from the quartiles of counts that add up over days: rows per calendar day, and
amounts per logarithmic step.  So one more day is one more merge, bounds of a period need
no row of it, and no window runs over rows.  What lies beyond ``factor`` times the middle
half's spread from it is an outlier; up to a quarter of the rows on one side can be wrong
before the quartile there moves to them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.contract import Contract
from ledgerline.functions.times import parse_utc
from ledgerline.operators.rollup import merged_sketch, sketch_step, step_value

FACTOR = 1.5
LEARNED_LABEL = "usual"


def quartiles(counts: DataFrame, value: str, *groups: str) -> DataFrame:
    """Groups, ``q1``, ``q3``: the smallest values that cover a quarter and three quarters.

    ``counts`` holds groups, ``value`` and ``n``, one row for each value of a group; the
    window orders these, not the rows behind them.  Null values stand below all others.
    """
    by_value = Window.partitionBy(*groups).orderBy(F.col(value).asc_nulls_first())
    upto = counts.select(
        *groups,
        value,
        F.sum("n").over(by_value).alias("upto"),
        F.sum("n").over(Window.partitionBy(*groups)).alias("total"),
    )
    # The first row that covers a share is the one with the least running count.
    covering = lambda share: F.min_by(
        value, F.when(F.col("upto") * 4 >= F.col("total") * share, F.col("upto"))
    )
    return upto.groupBy(*groups).agg(covering(1).alias("q1"), covering(3).alias("q3"))


def day_counts(records: DataFrame, date: str = "transaction_date") -> DataFrame:
    """``day``, ``n`` of records with strict UTC texts; others have no day and do not count."""
    day = parse_utc(F.col(date)).cast("date").alias("day")
    return records.select(day).where("day IS NOT NULL").groupBy("day").agg(F.count("*").alias("n"))


def usual_days(counts: DataFrame, factor: float = FACTOR) -> DataFrame:
    """One row: ``first_day``, ``last_day`` of the usual window; nulls without any day.

    ``counts`` are ``day_counts``, of any number of days or loads put together: days that
    occur several times are added up.  The spread is a day at least.
    """
    numbered = counts.groupBy(F.unix_date("day").alias("at")).agg(F.sum("n").alias("n"))
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(1))
    reach = F.ceil(spread * F.lit(float(factor))).cast("int")
    return quartiles(numbered, "at").select(
        F.date_from_unix_date((F.col("q1") - reach).cast("int")).alias("first_day"),
        F.date_from_unix_date((F.col("q3") + reach).cast("int")).alias("last_day"),
    )


def learned_contract(contract: Contract, counts: DataFrame, factor: float = FACTOR) -> Contract:
    """The contract with the usual window in place of its fixed one.

    The driver reads one row.  Without any day the contract stays as it is.
    """
    days = usual_days(counts, factor).select(
        F.date_format("first_day", "yyyy-MM-dd"), F.date_format("last_day", "yyyy-MM-dd")
    )
    first, last = days.first() or (None, None)
    if first is None:
        return contract
    return replace(
        contract,
        window_start=f"{first}T00:00:00Z",
        window_end=f"{last}T23:59:59Z",
        window_label=LEARNED_LABEL,
        strict_window=True,
    )


def usual_amounts(sketches: DataFrame, *groups: str, factor: float = FACTOR) -> DataFrame:
    """Groups, ``low_step``, ``high_step``, ``low``, ``high`` from daily sketches of amounts.

    Steps are logarithmic, so an amount is unusual by how many times it is larger or
    smaller than the middle half.  Values of 0 and below have no step: they are outliers,
    and a group in which they reach a quartile has no lower bound.
    """
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(1))
    reach = F.ceil(spread * F.lit(float(factor)))
    bounds = quartiles(merged_sketch(sketches, *groups), "step", *groups).select(
        *groups, (F.col("q1") - reach).alias("low_step"), (F.col("q3") + reach).alias("high_step")
    )
    return bounds.select(
        "*", step_value(F.col("low_step")).alias("low"), step_value(F.col("high_step")).alias("high")
    )


def unusual_amounts(
    rows: DataFrame, usual: DataFrame, amount: Column, groups: Sequence[str]
) -> DataFrame:
    """``rows`` whose amount is outside its group's bounds, with ``low`` and ``high``.

    Null amounts and rows of groups without bounds are not judged; null groups are
    groups.  The bounds are one row per group: adaptive execution broadcasts them where
    it finds them small, and splits a group with very many rows where it does not.
    """
    bounds = usual.select(
        *[F.col(g).alias(f"_of_{g}") for g in groups], "low_step", "high_step", "low", "high"
    )
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in groups]
    step = sketch_step(amount)
    outside = (step < F.col("low_step")) | (step > F.col("high_step")) | (amount <= 0)
    return rows.join(bounds, same).where(outside).select(*rows.columns, "low", "high")
