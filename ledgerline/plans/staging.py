"""The staging model: bronze without flagged duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_transactions(bronze: DataFrame) -> DataFrame:
    """Typed, renamed columns of every row that is not a duplicate, with its UTC date."""
    return bronze.where(~F.col("is_duplicate")).select(
        "transaction_id",
        "account_id",
        F.col("transaction_date").alias("transaction_timestamp"),
        F.col("transaction_date").cast("date").alias("transaction_date"),
        "amount",
        "currency",
        "transaction_type",
        "merchant_name",
        "merchant_category",
        "status",
        "country_code",
        "natural_key_hash",
        "ingestion_run_id",
        "ingestion_timestamp",
    )


def completed(staging: DataFrame) -> DataFrame:
    return staging.where(F.col("status") == "completed")
