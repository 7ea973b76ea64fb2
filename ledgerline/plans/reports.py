"""Report queries over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.combine import side_by_side
from ledgerline.operators.dedup import duplicate_members
from ledgerline.operators.routing import reason_counts

# The exports' column layouts below and these row counts.
SUMMARY_SAMPLE_ROWS = 100
BRONZE_SAMPLE_ROWS = 50


def quarantine_listing(quarantine: DataFrame) -> DataFrame:
    """All quarantined records, those with most violations first."""
    return quarantine.select(
        "transaction_id",
        "error_count",
        "error_reason",
        "ingestion_run_id",
        "ingestion_timestamp",
        "raw_payload",
    ).orderBy(F.desc("error_count"), F.asc_nulls_last("transaction_id"))


def summary_sample(summary: DataFrame, rows: int = SUMMARY_SAMPLE_ROWS) -> DataFrame:
    return summary.orderBy("account_id", "transaction_date").limit(rows)


def bronze_sample(bronze: DataFrame, rows: int = BRONZE_SAMPLE_ROWS) -> DataFrame:
    """The earliest rows; equal dates are ordered by id."""
    return (
        bronze.orderBy("transaction_date", "transaction_id")
        .limit(rows)
        .select(
            "transaction_id",
            "account_id",
            "transaction_date",
            "amount",
            "currency",
            "transaction_type",
            "merchant_name",
            "merchant_category",
            "status",
            "country_code",
            "is_duplicate",
            "ingestion_run_id",
            "ingestion_timestamp",
        )
    )


def duplicate_pairs(flagged: DataFrame) -> DataFrame:
    """Every member of a duplicate group, group by group."""
    return (
        duplicate_members(flagged)
        .orderBy("natural_key_hash", "transaction_id")
        .select(
            "transaction_id",
            "is_duplicate",
            "duplicate_of_transaction_id",
            "account_id",
            "transaction_date",
            "amount",
            "currency",
            "merchant_name",
            "merchant_category",
            "status",
            "country_code",
        )
    )


def warehouse_summary(flagged: DataFrame, quarantine: DataFrame, summary: DataFrame) -> DataFrame:
    """One row of counts, one aggregation per table.

    The reasons behind the quarantine count are a table of their own
    (:func:`ledgerline.operators.routing.reason_counts`): there is no bound on
    how many there are.
    """
    return side_by_side(
        flagged.agg(
            F.count("*").alias("raw_transactions"),
            F.count_if("is_duplicate").alias("raw_flagged_duplicate"),
        ),
        quarantine.agg(F.count("*").alias("quarantined")),
        summary.agg(
            F.count("*").alias("daily_account_summary_rows"),
            F.count_distinct("account_id").alias("distinct_accounts"),
        ),
    )


def pipeline_summary(
    flagged: DataFrame, quarantine: DataFrame, summary: DataFrame
) -> DataFrame:
    """The counts and all quarantine reasons as members: ``member``, ``name``, ``value``.

    A document in long form, as there is no bound on how many reasons there are.
    """
    counts = warehouse_summary(flagged, quarantine, summary)
    listed = F.array(
        *(F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in counts.columns)
    )
    reasons = reason_counts(quarantine).select(
        F.lit("quarantine_reasons").alias("member"),
        F.col("error_reason").alias("name"),
        F.col("record_count").alias("value"),
    )
    return counts.select(F.lit("counts").alias("member"), F.inline(listed)).unionByName(reasons)
