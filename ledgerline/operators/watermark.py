"""The event-time high-water mark and the request window that follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.times import back_days, format_utc


def high_water_mark(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.max("transaction_date").alias("high_water_mark"))


def advanced(previous: Column) -> Column:
    """The later of the previous mark and the newest stored date; it never moves back."""
    return F.greatest(previous, F.max("transaction_date")).alias("watermark_value")


def advance_watermark(previous: Column, bronze: DataFrame) -> DataFrame:
    newest = high_water_mark(bronze)
    return newest.select(F.greatest(previous, "high_water_mark").alias("watermark_value"))


def late_split(
    records: DataFrame, watermark: Column, lookback_days: int, date_field: str = "transaction_date"
) -> DataFrame:
    """Mark each record as one an incremental read still fetches or one it never sees."""
    start = format_utc(back_days(watermark, lookback_days))
    seen = F.coalesce(F.col(date_field) >= start, F.lit(False))
    return records.withColumn("arrival", F.when(seen, "accepted").otherwise("too_late"))
