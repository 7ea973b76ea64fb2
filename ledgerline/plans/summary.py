"""The daily account summary and the aggregates it is made of."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions.times import utc_literal
from ledgerline.plans.staging import completed

GRAIN = ["account_id", "transaction_date"]
MONEY = "decimal(18,2)"


def money(total: Column) -> Column:
    """A sum as money: nothing summed is zero."""
    return F.coalesce(total, F.lit(0)).cast(MONEY)


def direction_sum(direction: str) -> Column:
    return money(F.sum(F.when(F.col("transaction_type") == direction, F.col("amount"))))


def conditional_sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GRAIN).agg(
        direction_sum("debit").alias("total_debit_amount"),
        direction_sum("credit").alias("total_credit_amount"),
        F.count("*").alias("transaction_count"),
    )


def distinct_merchants(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GRAIN).agg(
        F.count_distinct("merchant_name").alias("distinct_merchants")
    )


def currency_list(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GRAIN).agg(
        F.array_join(F.sort_array(F.collect_set("currency")), ",").alias("currencies")
    )


def category_spend(rows: DataFrame) -> DataFrame:
    """Spend per category; debits and credits both count."""
    return rows.groupBy(*GRAIN, "merchant_category").agg(
        money(F.sum("amount")).alias("category_amount")
    )


def top_category(rows: DataFrame) -> DataFrame:
    """The category with the highest spend, ties broken by name."""
    rank = F.struct(-F.col("category_amount"), F.col("merchant_category"))
    return category_spend(rows).groupBy(*GRAIN).agg(
        F.min_by("merchant_category", rank).alias("top_category")
    )


def _finish(summary: DataFrame, as_of: datetime | None) -> DataFrame:
    now = F.localtimestamp() if as_of is None else utc_literal(as_of)
    net = F.col("total_credit_amount") - F.col("total_debit_amount")
    return (
        summary.withColumn("net_amount", net.cast(MONEY))
        .withColumn("updated_at", now)
        .select(schemas.SUMMARY.fieldNames())
    )


def daily_account_summary(staging: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """One row per account and UTC day over the completed transactions.

    One scan feeds three groupings of the same day: by category, by merchant and
    by currency.  Rows are first summed up by all three together, inside each task
    and then over a shuffle on these finer keys, so an account-day with a large
    share of all rows is spread; only the sums are then laid out once per view.
    Row order is left to the reader: it would not survive a stored table.
    """
    views = ["merchant_category", "merchant_name", "currency"]
    rows = completed(staging).select(*GRAIN, *views, "transaction_type", "amount")
    side = lambda name: F.sum(F.when(F.col("transaction_type") == name, F.col("amount")))
    sums = rows.groupBy(*GRAIN, *views).agg(
        side("debit").alias("debit"),
        side("credit").alias("credit"),
        F.sum("amount").alias("spend"),
        F.count("*").alias("n"),
    )
    # Each sum once per view; the view's number keeps the three apart.
    faces = sums.select(
        *GRAIN, "debit", "credit", "spend", "n",
        F.posexplode(F.array(*views)).alias("view", "label"),
    )
    by_category, by_merchant, by_currency = (F.col("view") == n for n in range(3))
    fine = faces.groupBy(*GRAIN, "view", "label").agg(
        F.sum("debit").alias("debit"),
        F.sum("credit").alias("credit"),
        F.sum("spend").alias("spend"),
        F.sum("n").alias("n"),
    )
    # Per day only the rows of one view count towards each measure.
    rank = F.when(by_category, F.struct(-F.col("spend"), F.col("label")))
    summary = fine.groupBy(*GRAIN).agg(
        money(F.sum(F.when(by_category, F.col("debit")))).alias("total_debit_amount"),
        money(F.sum(F.when(by_category, F.col("credit")))).alias("total_credit_amount"),
        F.sum(F.when(by_category, F.col("n"))).alias("transaction_count"),
        F.count_if(by_merchant & F.col("label").isNotNull()).alias("distinct_merchants"),
        F.min_by("label", rank).alias("top_category"),
        F.array_join(
            F.sort_array(F.collect_set(F.when(by_currency, F.col("label")))), ","
        ).alias("currencies"),
    )
    return _finish(summary, as_of)


def daily_account_summary_by_joins(
    staging: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """The same table as one aggregate left-joined to the top category."""
    rows = completed(staging)
    totals = rows.groupBy(*GRAIN).agg(
        direction_sum("debit").alias("total_debit_amount"),
        direction_sum("credit").alias("total_credit_amount"),
        F.count("*").alias("transaction_count"),
        F.count_distinct("merchant_name").alias("distinct_merchants"),
        F.array_join(F.sort_array(F.collect_set("currency")), ",").alias("currencies"),
    )
    return _finish(totals.join(top_category(rows), GRAIN, "left"), as_of)


_SUMMED = ["debit", "credit", "n"]
_COMPARED = [
    *GRAIN, "merchant_category", "merchant_name", "currency", "transaction_type", "amount",
]


def summary_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What changes per account-day between two versions of the same days of staging.

    ``account_id``, ``transaction_date`` and the differences of ``debit``, ``credit`` and
    ``n``: completed rows after count up, rows before count down.  Rows that are equal in
    what the summary is made of cancel out; an account-day is returned if any of its rows
    does not, also where the differences are all 0.
    """
    signed = completed(after).select("transaction_id", *_COMPARED, F.lit(1).alias("sign")).unionAll(
        completed(before).select("transaction_id", *_COMPARED, F.lit(-1).alias("sign"))
    )
    left = (
        signed.groupBy("transaction_id", *_COMPARED)
        .agg(F.sum("sign").alias("sign"))
        .where("sign <> 0")
    )
    side = lambda name: F.sum(
        F.when(F.col("transaction_type") == name, F.col("sign") * F.col("amount")).otherwise(0)
    )
    return left.groupBy(*GRAIN).agg(
        side("debit").cast(MONEY).alias("debit"),
        side("credit").cast(MONEY).alias("credit"),
        F.sum("sign").alias("n"),
    )


def merged_summary(
    summary: DataFrame, changes: DataFrame, after: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """``summary`` of some days, brought up to date by ``summary_changes`` in them.

    Totals and counts are those before plus the differences.  Distinct merchants, top
    category and currencies cannot be taken back from an aggregate: they are computed
    from the rows of the changed account-days.  Other account-days stay as they are,
    with their ``updated_at``; one without rows goes.
    """
    touched = changes.select(*GRAIN)
    fresh = daily_account_summary(after.join(touched, GRAIN, "left_semi"), as_of).select(
        *GRAIN, "distinct_merchants", "top_category", "currencies"
    )
    old = summary.select(
        *GRAIN, "total_debit_amount", "total_credit_amount", "transaction_count"
    )
    moved = changes.join(old, GRAIN, "left").select(
        *GRAIN,
        (F.coalesce("total_debit_amount", F.lit(0)) + F.col("debit")).cast(MONEY).alias("total_debit_amount"),
        (F.coalesce("total_credit_amount", F.lit(0)) + F.col("credit")).cast(MONEY).alias("total_credit_amount"),
        (F.coalesce("transaction_count", F.lit(0)) + F.col("n")).alias("transaction_count"),
    )
    changed = _finish(moved.where("transaction_count > 0").join(fresh, GRAIN), as_of)
    kept = summary.join(touched, GRAIN, "left_anti").select(schemas.SUMMARY.fieldNames())
    return kept.unionByName(changed)
