"""Signals over the run audit and the stored tables.

The audit holds one row per run and the daily counts one row per day, so the
windows below order short lists; anything larger is aggregated first.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.contract import Contract
from ledgerline.functions.times import utc_literal
from ledgerline.operators.rollup import daily_sketch, quantile_of
from ledgerline.plans.summary import GRAIN, MONEY
from ledgerline.sources.landing import parse_records

# Fixed thresholds of the alert rules.
MAX_QUARANTINE_RATE = 0.02
RATE_FACTOR = 3
BASELINE_DAYS = 7
VOLUME_DAYS = 30
VOLUME_SIGMAS = 3
DURATION_FACTOR = 3
STALE_HOURS = 26

_DAY_SECONDS = 86_400


def _seconds(timestamp: Column) -> Column:
    return F.unix_timestamp(timestamp.cast("timestamp"))


def _trailing_days(days: int) -> Window:
    """The runs of the same source in the days before a run."""
    return (
        Window.partitionBy("source_name")
        .orderBy(_seconds(F.col("started_at")))
        .rangeBetween(-days * _DAY_SECONDS, -1)
    )


def _rate(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole))


def schema_drift(payloads: DataFrame, contract: Contract) -> DataFrame:
    """Members outside the contract and how many records carry each."""
    known = contract.record_fields + contract.metadata_fields
    return (
        parse_records(payloads, contract)
        .select(F.explode("_keys").alias("field"))
        .where(~F.col("field").isin(*known))
        .groupBy("field")
        .agg(F.count("*").alias("record_count"))
    )


def quarantine_rate_alerts(runs: DataFrame) -> DataFrame:
    """Rate of each run, its trailing baseline and whether the run is suspicious."""
    rated = runs.select(
        "run_id", "source_name", "started_at", _rate("records_quarantined", "records_fetched").alias("rate")
    )
    baseline = F.avg("rate").over(_trailing_days(BASELINE_DAYS))
    alert = (F.col("rate") > MAX_QUARANTINE_RATE) | (
        F.col("rate") > RATE_FACTOR * F.col("baseline")
    )
    return rated.withColumn("baseline", baseline).select(
        "run_id", "rate", "baseline", F.coalesce(alert, F.lit(False)).alias("alert")
    )


def duplicate_rate_steps(runs: DataFrame) -> DataFrame:
    """Runs whose duplicate rate jumps above the factor of its trailing baseline.

    The rate is that of the batch: duplicates among the rows a run brought, not all
    that the table holds by then.
    """
    rated = runs.select(
        "run_id",
        "source_name",
        "started_at",
        _rate("records_duplicate_in_batch", "records_valid").alias("rate"),
    )
    baseline = F.avg("rate").over(_trailing_days(BASELINE_DAYS))
    step = F.col("rate") > RATE_FACTOR * F.col("baseline")
    return rated.withColumn("baseline", baseline).select(
        "run_id", "rate", "baseline", F.coalesce(step, F.lit(False)).alias("alert")
    )


def new_reasons(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Reasons of a quarantine batch that the history does not know."""
    seen = history.select("error_reason").distinct()
    return batch.select("error_reason").distinct().join(seen, "error_reason", "left_anti")


def daily_counts(bronze: DataFrame) -> DataFrame:
    """Rows of every calendar day from the first to the last one; days without rows count 0."""
    day = F.col("transaction_date").cast("date").alias("day")
    found = bronze.groupBy(day).agg(F.count("*").alias("row_count"))
    return every_day(found)


def every_day(counts: DataFrame) -> DataFrame:
    """``day``, ``row_count`` without gaps: one row per calendar day."""
    days = counts.agg(
        F.sequence(F.min("day"), F.max("day"), F.make_dt_interval(days=F.lit(1))).alias("days")
    ).select(F.explode("days").alias("day"))
    return days.join(counts, "day", "left").select(
        "day", F.coalesce("row_count", F.lit(0)).alias("row_count")
    )


def volume_anomalies(counts: DataFrame) -> DataFrame:
    """Days whose count leaves the band around the mean of the trailing days.

    ``counts`` has at most one row per calendar day, whatever the size of the table.
    A day that is missing between the first and the last one is a day of 0 rows: it
    is judged, and it counts in the mean of the days after it.
    """
    counts = every_day(counts)
    trailing = Window.orderBy(F.unix_date("day")).rangeBetween(-VOLUME_DAYS, -1)
    banded = counts.withColumn("mean", F.avg("row_count").over(trailing)).withColumn(
        "spread", F.stddev("row_count").over(trailing)
    )
    off = F.abs(F.col("row_count") - F.col("mean")) > VOLUME_SIGMAS * F.col("spread")
    return banded.select(
        "day", "row_count", "mean", "spread", F.coalesce(off, F.lit(False)).alias("anomaly")
    )


def run_health(runs: DataFrame, now: datetime) -> DataFrame:
    """One row per run with the alerts that concern the run itself."""
    duration = _seconds(F.col("ended_at")) - _seconds(F.col("started_at"))
    timed = runs.withColumn("duration", duration)
    in_order = Window.partitionBy("source_name").orderBy("started_at", "run_id")
    usual = F.percentile("duration", 0.5).over(_trailing_days(BASELINE_DAYS))
    # Unchanged in this run and in the one before, while both brought rows not seen before.
    unmoved = F.col("new_watermark") == F.lag("new_watermark", 1).over(in_order)
    brought = F.col("records_new") > 0
    both = lambda c: c & F.lag(c, 1).over(in_order)
    timed = timed.withColumn("_unmoved", F.coalesce(unmoved, F.lit(False)) & brought)
    stuck = both(F.col("_unmoved"))
    business_day = F.weekday("started_at") < 5
    newest = F.max(F.when(F.col("status") == "success", F.col("ended_at"))).over(
        Window.partitionBy("source_name")
    )
    stale = _seconds(utc_literal(now)) - _seconds(newest) > STALE_HOURS * 3600
    alerts = {
        "failed": F.col("status") == "failed",
        "slow": F.col("duration") > DURATION_FACTOR * usual,
        "stuck_watermark": stuck,
        "zero_rows": business_day & (F.col("records_valid") == 0),
        "stale_source": stale,
    }
    return timed.select(
        "run_id", *[F.coalesce(c, F.lit(False)).alias(name) for name, c in alerts.items()]
    )


def lookback_from_lag(bronze: DataFrame, share: float = 0.99) -> DataFrame:
    """The fewest whole days that cover the given share of ingestion lags.

    Rows are first counted per day of lag, so the running total that finds
    the share orders one row per day.
    """
    lag = _seconds(F.col("ingestion_timestamp")) - _seconds(F.col("transaction_date"))
    lag_days = F.ceil(lag / _DAY_SECONDS).alias("lag_days")
    histogram = bronze.groupBy(lag_days).agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.orderBy("lag_days"))
    total = F.sum("n").over(Window.partitionBy())
    covered = histogram.select("lag_days", running.alias("running"), total.alias("total"))
    return covered.where(F.col("running") >= share * F.col("total")).agg(
        F.min("lag_days").cast("bigint").alias("lookback_days")
    )


def reporting_amounts(completed: DataFrame, rates: DataFrame) -> DataFrame:
    """Daily account totals in the reporting currency.

    ``rates`` holds ``currency``, ``transaction_date`` and ``rate``.  Rows are
    summed per currency before they meet the rates, so a currency with a
    third of all rows reaches the join as one row per account-day.  Whether the
    rates are broadcast is left to adaptive execution, which knows their size.
    """
    signed = F.when(F.col("transaction_type") == "credit", F.col("amount")).otherwise(
        -F.col("amount")
    )
    native = completed.groupBy(*GRAIN, "currency").agg(
        F.sum(signed).cast(MONEY).alias("net_amount")
    )
    converted = native.join(rates, ["currency", "transaction_date"], "left")
    return converted.groupBy(*GRAIN).agg(
        F.sum(F.col("net_amount") * F.col("rate")).cast(MONEY).alias("net_reporting_amount"),
        F.count_if(F.col("rate").isNull()).alias("currencies_without_rate"),
    )


def rates_as_of(days: DataFrame, rates: DataFrame) -> DataFrame:
    """``currency``, ``transaction_date``, ``rate``, ``rate_date``: the latest rate on or before.

    ``days`` holds the currencies and days asked for.  Only distinct ones meet the rates,
    so a group of the window has no more rows than there are days, however many rows a
    currency has.  Days before a currency's first rate get none.
    """
    keys = ["currency", "transaction_date"]
    asked = days.select(*keys).distinct().withColumn("rate", F.lit(None).cast("decimal(10,4)"))
    known = rates.select(*keys, F.col("rate").cast("decimal(10,4)").alias("rate"))
    both = asked.withColumn("asked", F.lit(True)).unionByName(known.withColumn("asked", F.lit(False)))
    # Within a day the rate stands before the day asked for.
    until = Window.partitionBy("currency").orderBy("transaction_date", "asked")
    carried = F.last(F.when(~F.col("asked"), F.struct("rate", "transaction_date")), ignorenulls=True)
    return (
        both.withColumn("last", carried.over(until))
        .where("asked")
        .select(*keys, F.col("last.rate").alias("rate"), F.col("last.transaction_date").alias("rate_date"))
    )


def reporting_amounts_as_of(completed: DataFrame, rates: DataFrame) -> DataFrame:
    """``reporting_amounts`` with the latest rate on or before each day.

    Days between rates are converted; ``currencies_without_rate`` counts those before a
    currency's first rate.
    """
    return reporting_amounts(completed, rates_as_of(completed, rates).drop("rate_date"))


def days_without_rate(completed: DataFrame, rates: DataFrame) -> DataFrame:
    """``currency``, ``transaction_date`` of completed rows before the currency's first rate."""
    found = rates_as_of(completed, rates)
    return found.where("rate_date IS NULL").select("currency", "transaction_date")


def lag_sketch(bronze: DataFrame) -> DataFrame:
    """``day``, ``step``, ``n``: ingestion lags in seconds by day of ingestion, mergeable."""
    lag = _seconds(F.col("ingestion_timestamp")) - _seconds(F.col("transaction_date"))
    dated = bronze.withColumn("day", F.col("ingestion_timestamp").cast("date"))
    return daily_sketch(dated, "day", lag)


def lookback_from_sketch(sketches: DataFrame, share: float = 0.99) -> DataFrame:
    """The whole days that cover the given share of lags, from sketches of days alone.

    The lag is known to one part in a hundred, and so are the days before rounding up.
    """
    days = F.ceil(F.col("quantile") / _DAY_SECONDS)
    return quantile_of(sketches, share).select(days.cast("bigint").alias("lookback_days"))

