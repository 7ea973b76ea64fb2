"""Checking records and routing them to the bronze or the quarantine layout."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.contract import Contract
from ledgerline.functions.checks import text_view, violations
from ledgerline.functions.keys import natural_key_hash, payload_key
from ledgerline.functions.text import ascii_json
from ledgerline.functions.times import parse_utc, utc_literal
from ledgerline.sources.landing import Taken, json_view, parse_records

DEFAULT_SOURCE = "landing.transactions"


def check_table(records: DataFrame, contract: Contract) -> DataFrame:
    """Add ``violations`` to a table that holds every contract field as a string."""
    return records.withColumn("violations", violations(contract, text_view(contract)))


def check_payloads(records: DataFrame, contract: Contract, taken: Taken | None = None) -> DataFrame:
    """Parse the ``payload`` texts: fields, canonical payload, ``is_object``, ``violations``.

    A payload that is no JSON keeps its original text.  Records that ``taken`` refuses are
    parsed but neither checked nor printed: ``transaction_date`` and ``is_object`` stand,
    there are no violations, and the other columns are NULL.
    """
    parsed = parse_records(records, contract, taken)
    is_object = F.col("_keys").isNotNull()
    payload = F.coalesce(ascii_json(F.col("_json")), F.col("payload"))
    found = violations(contract, json_view(contract))
    if taken is not None:
        wanted = taken(F.col("transaction_date"), is_object)
        payload = F.when(wanted, payload)
        found = F.when(wanted, found).otherwise(F.array().cast("array<string>"))
    return parsed.select(
        *contract.record_fields,
        is_object.alias("is_object"),
        payload.alias("payload"),
        found.alias("violations"),
    )


def table_payload(contract: Contract) -> Column:
    """The canonical payload of a string table; NULL fields count as absent."""
    return F.to_json(F.struct(*sorted(contract.record_fields)))


def is_valid() -> Column:
    return F.size("violations") == 0


def _stamp(source: str, run_id: str, as_of: datetime) -> list[Column]:
    return [
        F.lit(source).alias("source_system"),
        F.col("payload").alias("source_payload"),
        F.lit(run_id).alias("ingestion_run_id"),
        utc_literal(as_of).alias("ingestion_timestamp"),
    ]


def bronze_rows(
    checked: DataFrame, contract: Contract, source: str, run_id: str, as_of: datetime
) -> DataFrame:
    """The valid records, typed and keyed, not yet flagged."""
    values = {f: F.col(f) for f in contract.record_fields}
    rows = checked.where(is_valid()).select(
        "transaction_id",
        "account_id",
        parse_utc(F.col("transaction_date")).alias("transaction_date"),
        F.col("transaction_date").alias("transaction_date_raw"),
        F.col("amount").try_cast("decimal(18,2)").alias("amount"),
        "currency",
        "transaction_type",
        "merchant_name",
        "merchant_category",
        "status",
        "country_code",
        natural_key_hash(contract, values).alias("natural_key_hash"),
        F.lit(False).alias("is_duplicate"),
        F.lit(None).cast("string").alias("duplicate_of_transaction_id"),
        *_stamp(source, run_id, as_of),
    )
    return rows.select(schemas.BRONZE.fieldNames())


def quarantine_rows(
    checked: DataFrame, source: str, run_id: str, as_of: datetime
) -> DataFrame:
    """The invalid records with everything that is wrong with them."""
    system, payload, run, stamp = _stamp(source, run_id, as_of)
    return checked.where(~is_valid()).select(
        payload_key(payload).alias("quarantine_key"),
        "transaction_id",
        F.array_join("violations", "; ").alias("error_reason"),
        F.size("violations").alias("error_count"),
        payload.alias("raw_payload"),
        system,
        run,
        stamp,
    )


def reason_counts(quarantine: DataFrame) -> DataFrame:
    """How often each reason occurs, most frequent first."""
    return (
        quarantine.groupBy("error_reason")
        .agg(F.count("*").alias("record_count"))
        .orderBy(F.desc("record_count"), "error_reason")
    )
