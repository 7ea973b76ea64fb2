"""Column layouts of the stored tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Fixed layouts: names, types and their order.
BRONZE = (
    StructType()
    .add("transaction_id", "string")
    .add("account_id", "string")
    .add("transaction_date", "timestamp_ntz")
    .add("transaction_date_raw", "string")
    .add("amount", "decimal(18,2)")
    .add("currency", "string")
    .add("transaction_type", "string")
    .add("merchant_name", "string")
    .add("merchant_category", "string")
    .add("status", "string")
    .add("country_code", "string")
    .add("natural_key_hash", "string")
    .add("is_duplicate", "boolean")
    .add("duplicate_of_transaction_id", "string")
    .add("source_system", "string")
    .add("source_payload", "string")
    .add("ingestion_run_id", "string")
    .add("ingestion_timestamp", "timestamp_ntz")
)

QUARANTINE = (
    StructType()
    .add("quarantine_key", "string")
    .add("transaction_id", "string")
    .add("error_reason", "string")
    .add("error_count", "integer")
    .add("raw_payload", "string")
    .add("source_system", "string")
    .add("ingestion_run_id", "string")
    .add("ingestion_timestamp", "timestamp_ntz")
)

WATERMARK = (
    StructType()
    .add("source_name", "string")
    .add("watermark_value", "timestamp_ntz")
    .add("effective_request_from", "timestamp_ntz")
    .add("last_run_id", "string")
    .add("last_run_at", "timestamp_ntz")
    .add("last_run_status", "string")
    .add("records_ingested", "long")
)

RUNS = (
    StructType()
    .add("run_id", "string")
    .add("source_name", "string")
    .add("run_mode", "string")
    .add("requested_from", "timestamp_ntz")
    .add("started_at", "timestamp_ntz")
    .add("ended_at", "timestamp_ntz")
    .add("status", "string")
    .add("records_fetched", "long")
    .add("records_valid", "long")
    .add("records_quarantined", "long")
    .add("records_duplicate_flagged", "long")
    .add("records_new", "long")
    .add("records_duplicate_in_batch", "long")
    .add("records_late_rejected", "long")
    .add("previous_watermark", "timestamp_ntz")
    .add("new_watermark", "timestamp_ntz")
    .add("error_message", "string")
)

SUMMARY = (
    StructType()
    .add("account_id", "string")
    .add("transaction_date", "date")
    .add("total_debit_amount", "decimal(18,2)")
    .add("total_credit_amount", "decimal(18,2)")
    .add("net_amount", "decimal(18,2)")
    .add("transaction_count", "long")
    .add("distinct_merchants", "long")
    .add("top_category", "string")
    .add("currencies", "string")
    .add("updated_at", "timestamp_ntz")
)

REPORT = (
    StructType()
    .add("run_id", "string")
    .add("run_mode", "string")
    .add("source_name", "string")
    .add("requested_from", "string")
    .add("records_fetched", "long")
    .add("records_valid", "long")
    .add("records_quarantined", "long")
    .add("records_duplicate_flagged", "long")
    .add("records_late_rejected", "long")
    .add("previous_watermark", "string")
    .add("new_watermark", "string")
    .add("lookback_days", "integer")
    .add("duration_seconds", "double")
    .add("status", "string")
)

DELIVERIES = StructType().add("delivery", "string").add("run_id", "string")
