"""Content checksums and the proof that a rebuild changes nothing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import row_digest
from ledgerline.operators.combine import side_by_side

SUMMARY_CONTENT = (
    "account_id",
    "transaction_date",
    "total_debit_amount",
    "total_credit_amount",
    "net_amount",
    "transaction_count",
    "distinct_merchants",
    "top_category",
    "currencies",
)


def table_checksum(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and an order-free sum of row hashes over the listed columns."""
    digest = row_digest([F.col(c) for c in columns])
    return table.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(digest), F.lit(0)).cast("decimal(38,0)").alias("content_checksum"),
    )


def portable_checksum(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same idea with a hash other engines compute too: leading MD5 digits."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("decimal(38,0)")
    return table.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(number), F.lit(0)).cast("decimal(38,0)").alias("content_checksum"),
    )


def rebuild_proof(build: Callable[[], DataFrame], columns: Sequence[str]) -> DataFrame:
    """Build twice and compare: both checksums and whether they are the same."""
    sides = [
        table_checksum(build(), columns).select(
            F.struct("row_count", "content_checksum").alias(name)
        )
        for name in ("before", "after")
    ]
    return side_by_side(*sides).select(
        F.col("before.row_count").alias("rows_before"),
        F.col("after.row_count").alias("rows_after"),
        F.col("before.content_checksum").alias("checksum_before"),
        F.col("after.content_checksum").alias("checksum_after"),
        (F.col("before") == F.col("after")).alias("identical"),
    )


def is_idempotent(build: Callable[[], DataFrame], columns: Sequence[str]) -> bool:
    return bool(rebuild_proof(build, columns).first()["identical"])
