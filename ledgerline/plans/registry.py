"""The registered queries: every operator over the whole derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.checks import field_checks, label, text_view
from ledgerline.functions.keys import natural_key, natural_key_hash, payload_key
from ledgerline.functions.times import back_days, format_utc
from ledgerline.operators import (
    checksum,
    dedup,
    monitoring,
    outliers,
    quality,
    rollup,
    routing,
    watermark,
)
from ledgerline.operators.ordered import ordered_pages
from ledgerline.operators.upsert import upsert
from ledgerline.plans import reports, summary
from ledgerline.plans.fixture import FIRST_LOAD_END, load, payloads
from ledgerline.plans.staging import completed
from ledgerline.plans.warehouse import AS_OF, LOOKBACK_DAYS, Warehouse, warehouse
from ledgerline.session import materialize, scratch_path
from ledgerline.sources import sinks
from ledgerline.sources.landing import (
    incremental_scan,
    json_view,
    keyset_page,
    offset_page,
    parse_records,
)
from ledgerline.sources.sinks import latest_run, watermark_snapshot

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAGE_ROWS = 200
BUSINESS = [
    "transaction_id",
    "account_id",
    "transaction_date",
    "transaction_date_raw",
    "amount",
    "currency",
    "transaction_type",
    "merchant_name",
    "merchant_category",
    "status",
    "country_code",
    "natural_key_hash",
    "is_duplicate",
    "duplicate_of_transaction_id",
]
CONTENT = list(checksum.SUMMARY_CONTENT)


def register(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Register a query under the name of its function, less a trailing underscore."""
    QUERIES[build.__name__.rstrip("_")] = lambda spark, sf_dir: build(warehouse(spark, sf_dir))
    return build


# Sources and scans.


@register
def landing_scan(w: Warehouse) -> DataFrame:
    return parse_records(w.landed, w.contract).select(*w.contract.record_fields)


def _first_mark(w: Warehouse) -> F.Column:
    """The watermark after the first of two loads, as a scalar subquery."""
    first = w.bronze.where(F.col("transaction_date_raw") < FIRST_LOAD_END)
    return watermark.high_water_mark(first).scalar()


@register
def incremental_scan_(w: Warehouse) -> DataFrame:
    return incremental_scan(w.txn, _first_mark(w), LOOKBACK_DAYS)


@register
def stable_page(w: Warehouse) -> DataFrame:
    return offset_page(w.txn, PAGE_ROWS, 2 * PAGE_ROWS)


@register
def keyset_next_page(w: Warehouse) -> DataFrame:
    return keyset_page(w.txn, PAGE_ROWS, after=("2024-01-15T12:00:00Z", ""))


# Record checks: the records one check refuses, with the text it reports.


def _register_check(
    name: str, field: str, code: str, expected: str = "", from_json: bool = False
) -> None:
    def build(w: Warehouse) -> DataFrame:
        if from_json:
            view = json_view(w.contract)
            records = parse_records(payloads(w.spark, w.sf_dir), w.contract)
        else:
            view, records = text_view(w.contract), w.txn
        check = next(c for c in field_checks(w.contract, view) if c.field == field)
        return records.where(check.problem == label(field, code, expected)).select(
            "transaction_id", F.col(field).alias("value"), check.text.alias("violation")
        )

    QUERIES[name] = lambda spark, sf_dir: build(warehouse(spark, sf_dir))


_register_check("v_txn_id", "transaction_id", "invalid_format", "expected TXN-NNNN, ")
_register_check("v_account_id", "account_id", "invalid_format", "expected ACC-NNNN, ", True)
_register_check("v_ts_format", "transaction_date", "invalid_iso8601_utc_format")
_register_check("v_ts_calendar", "transaction_date", "not_a_real_calendar_date")
_register_check("v_ts_window", "transaction_date", "outside_expected_window_2024Q1")
_register_check("v_amount_numeric", "amount", "not_numeric")
_register_check("v_amount_positive", "amount", "not_strictly_positive")
_register_check("v_amount_scale", "amount", "more_than_two_decimal_places")
_register_check("v_currency", "currency", "invalid_currency_code")
_register_check("v_type", "transaction_type", "invalid_transaction_type")
_register_check("v_category", "merchant_category", "invalid_merchant_category")
_register_check("v_status", "status", "invalid_status")
_register_check("v_merchant", "merchant_name", "empty_or_whitespace_only")
_register_check("v_country_format", "country_code", "invalid_format", from_json=True)
_register_check("v_country_assigned", "country_code", "not_an_assigned_iso3166_code")


@register
def v_missing(w: Warehouse) -> DataFrame:
    names = F.array_compact(
        F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in w.contract.record_fields])
    )
    return w.txn.select("transaction_id", F.explode(names).alias("field"))


@register
def v_unexpected(w: Warehouse) -> DataFrame:
    drift = F.filter("violations", lambda v: v.endswith(": unexpected_field"))
    return w.checked_payloads.where(F.exists("violations", lambda v: v.endswith(": unexpected_field"))).select(
        "transaction_id", F.array_join(drift, "; ").alias("violation")
    )


@register
def validate_all(w: Warehouse) -> DataFrame:
    return w.checked_now.select(
        *w.contract.record_fields,
        F.array_join("violations", "; ").alias("error_reason"),
        F.size("violations").alias("error_count"),
    )


@register
def validate_payloads(w: Warehouse) -> DataFrame:
    checked = routing.check_payloads(payloads(w.spark, w.sf_dir), w.contract)
    return checked.select(
        "transaction_id",
        F.array_join("violations", "; ").alias("error_reason"),
        F.size("violations").alias("error_count"),
    )


@register
def route_valid(w: Warehouse) -> DataFrame:
    return w.valid


@register
def route_quarantine(w: Warehouse) -> DataFrame:
    return w.quarantine


@register
def quarantine_reasons(w: Warehouse) -> DataFrame:
    return routing.reason_counts(w.quarantine)


# Keys, hashes and checksums.


@register
def natural_key_(w: Warehouse) -> DataFrame:
    values = {f: F.col(f) for f in w.contract.record_fields}
    return w.txn.select("transaction_id", natural_key(w.contract, values).alias("natural_key"))


@register
def natural_key_hash_(w: Warehouse) -> DataFrame:
    values = {f: F.col(f) for f in w.contract.record_fields}
    return w.txn.select(
        "transaction_id", natural_key_hash(w.contract, values).alias("natural_key_hash")
    )


@register
def payload_key_(w: Warehouse) -> DataFrame:
    return w.checked_payloads.select(
        "transaction_id", "payload", payload_key(F.col("payload")).alias("quarantine_key")
    )


@register
def table_checksum(w: Warehouse) -> DataFrame:
    return checksum.portable_checksum(w.summary, CONTENT)


@register
def idempotency(w: Warehouse) -> DataFrame:
    proof = checksum.rebuild_proof(lambda: summary.daily_account_summary(w.staging), CONTENT)
    return proof.select("rows_before", "rows_after", "identical")


# Duplicates.


@register
def flag_duplicates(w: Warehouse) -> DataFrame:
    return dedup.flag_duplicates(w.bronze).select(BUSINESS)


@register
def duplicate_pairs(w: Warehouse) -> DataFrame:
    return reports.duplicate_pairs(w.flagged)


@register
def duplicate_count(w: Warehouse) -> DataFrame:
    return dedup.flagged_count(w.flagged)


@register
def lineitem_duplicates(w: Warehouse) -> DataFrame:
    """The same flags on another table."""
    return dedup.flag_duplicates(w.order_lines, "line_key", "l_shipdate", "line_id")


# Upsert, joins and aggregates.


@register
def upsert_merge(w: Warehouse) -> DataFrame:
    """The first load, then everything since: replaced rows carry the newer run id."""
    raw = F.col("transaction_date_raw")
    target = w.bronze.where(raw < FIRST_LOAD_END)
    start = format_utc(back_days(_first_mark(w), LOOKBACK_DAYS))
    batch = w.bronze.where(raw >= start).withColumn("ingestion_run_id", F.lit("run-2"))
    return upsert(target, batch, "transaction_id").select(
        "transaction_id", "natural_key_hash", "amount", "ingestion_run_id"
    )


@register
def mart_left_join(w: Warehouse) -> DataFrame:
    return summary.daily_account_summary_by_joins(w.staging, AS_OF).select(CONTENT)


@register
def cond_sums(w: Warehouse) -> DataFrame:
    return summary.conditional_sums(completed(w.staging))


@register
def distinct_merchants(w: Warehouse) -> DataFrame:
    return summary.distinct_merchants(completed(w.staging))


@register
def currency_list(w: Warehouse) -> DataFrame:
    return summary.currency_list(completed(w.staging))


@register
def category_spend(w: Warehouse) -> DataFrame:
    return summary.category_spend(completed(w.staging))


@register
def top_category(w: Warehouse) -> DataFrame:
    return summary.top_category(completed(w.staging))


@register
def high_water_mark(w: Warehouse) -> DataFrame:
    return watermark.high_water_mark(w.bronze)


# Models and reports.


@register
def stg_transactions(w: Warehouse) -> DataFrame:
    return w.staging


@register
def daily_account_summary(w: Warehouse) -> DataFrame:
    return summary.daily_account_summary(w.staging, AS_OF).select(CONTENT)


@register
def mart_sample(w: Warehouse) -> DataFrame:
    return reports.summary_sample(w.summary).select(CONTENT)


@register
def bronze_sample(w: Warehouse) -> DataFrame:
    return reports.bronze_sample(w.flagged)


@register
def quarantine_sample(w: Warehouse) -> DataFrame:
    return reports.quarantine_listing(w.quarantine)


@register
def warehouse_summary(w: Warehouse) -> DataFrame:
    return reports.warehouse_summary(w.flagged, w.quarantine, w.summary)


@register
def pipeline_summary(w: Warehouse) -> DataFrame:
    """The document of the same counts and the reasons, one row per reason."""
    return reports.pipeline_summary(w.flagged, w.quarantine, w.summary)


# Increments, runs and streams.


@register
def advance_watermark(w: Warehouse) -> DataFrame:
    return watermark.advance_watermark(_first_mark(w), w.bronze)


@register
def late_split(w: Warehouse) -> DataFrame:
    split = watermark.late_split(w.txn, _first_mark(w), LOOKBACK_DAYS)
    return split.select("transaction_id", "transaction_date", "arrival")


@register
def ingest_full(w: Warehouse) -> DataFrame:
    return w.full_store.bronze.read().select(BUSINESS)


@register
def ingest_quarantine(w: Warehouse) -> DataFrame:
    return w.full_store.quarantine.read().select(
        "quarantine_key", "transaction_id", "error_reason", "error_count", "raw_payload"
    )


@register
def ingest_incremental(w: Warehouse) -> DataFrame:
    store, _ = w.two_loads
    return store.bronze.read().select(*BUSINESS, "ingestion_run_id")


@register
def ingest_incremental_payloads(w: Warehouse) -> DataFrame:
    """The quarantine of both loads: payloads without a date are taken by either."""
    return w.payload_loads.quarantine.read().select(
        "quarantine_key", "transaction_id", "error_reason", "ingestion_run_id"
    )


@register
def incremental_summary(w: Warehouse) -> DataFrame:
    store, _ = w.two_loads
    return store.summary.read().select(CONTENT)


@register
def summary_rebuild(w: Warehouse) -> DataFrame:
    return w.full_store.summary.read().select(CONTENT)


@register
def replay_idempotent(w: Warehouse) -> DataFrame:
    return w.replayed_store.bronze.read().select(*BUSINESS, "ingestion_run_id")


@register
def upsert_quarantine(w: Warehouse) -> DataFrame:
    return w.replayed_store.quarantine.read().select(
        "quarantine_key", "error_reason", "ingestion_run_id"
    )


@register
def ingest_stream(w: Warehouse) -> DataFrame:
    return w.streamed_store.bronze.read().select(BUSINESS)


@register
def run_report(w: Warehouse) -> DataFrame:
    _, reports_ = w.two_loads
    return reports_


@register
def run_audit(w: Warehouse) -> DataFrame:
    store, _ = w.two_loads
    return store.runs.current("run_id").orderBy("started_at")


def _rounded(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "run_id", F.round("rate", 9).alias("rate"), F.round("baseline", 9).alias("baseline"), "alert"
    )


@register
def duplicate_steps_of_loads(w: Warehouse) -> DataFrame:
    """The rule on the audit that the runs themselves wrote."""
    store, _ = w.two_loads
    return _rounded(monitoring.duplicate_rate_steps(store.runs.current("run_id")))


@register
def health_of_replays(w: Warehouse) -> DataFrame:
    """Two loads of the same records: the second one brings nothing new and is healthy."""
    return monitoring.run_health(w.replayed_store.runs.current("run_id"), AS_OF)


@register
def latest_run_(w: Warehouse) -> DataFrame:
    store, _ = w.two_loads
    return latest_run(store.runs.current("run_id")).select(
        "run_id", "status", "records_fetched", "new_watermark"
    )


@register
def watermark_upsert(w: Warehouse) -> DataFrame:
    store, _ = w.two_loads
    return store.watermark.current("source_name")


@register
def watermark_snapshot_(w: Warehouse) -> DataFrame:
    store, _ = w.two_loads
    return watermark_snapshot(store, routing.DEFAULT_SOURCE).select(
        "watermark_store.watermark_value",
        "watermark_store.effective_request_from",
        "last_run.run_id",
        "table_counts.*",
    )


@register
def watermark_read(w: Warehouse) -> DataFrame:
    """The stored watermark and where the next request of the source starts."""
    store, _ = w.two_loads
    mark = store.watermark.current().where(F.col("source_name") == routing.DEFAULT_SOURCE)
    start = back_days(F.col("watermark_value"), LOOKBACK_DAYS)
    return mark.select("source_name", "watermark_value", format_utc(start).alias("next_request_from"))


@register
def upsert_indexed(w: Warehouse) -> DataFrame:
    """All rows, then those pending a day later as a batch: moved rows leave their old day."""
    return w.moved_store.bronze.read().select(
        "transaction_id", "account_id", "transaction_date", "status", "ingestion_run_id"
    )


@register
def commit_aggregates(w: Warehouse) -> DataFrame:
    """Counts and newest date per day as the commit list has them."""
    days = w.full_store.bronze.stats()
    rows = [(d, s["rows"], s["duplicates"], s["newest"]) for d, s in sorted(days.items())]
    schema = "day string, row_count long, duplicates long, newest string"
    return w.spark.createDataFrame(rows, schema).withColumn(
        "newest", F.col("newest").cast("timestamp_ntz")
    )


@register
def blocked_publish(w: Warehouse) -> DataFrame:
    """A run that brings drift and is held back: what readers see, and what the audit says."""
    store = w.blocked_store
    last = latest_run(store.runs.current())
    told = [last.select(c).scalar().alias(c) for c in ("status", "records_valid", "error_message")]
    return store.bronze.read().select("transaction_id", "ingestion_run_id", *told)


@register
def ordered_export(w: Warehouse) -> DataFrame:
    """Every page of the whole table at once."""
    pages = ordered_pages(w.txn, PAGE_ROWS, ["transaction_date", "transaction_id"])
    return pages.select("page", "position", "transaction_date", "transaction_id")


@register
def export_csv(w: Warehouse) -> DataFrame:
    """The summary written as CSV and read back as text."""
    path = scratch_path(w.spark, "export")
    sinks.export_csv(w.summary.select(CONTENT), path)
    return w.spark.read.csv(path, header=True, escape='"')


@register
def monthly_merchants(w: Warehouse) -> DataFrame:
    """Distinct merchants per account and month, from bitmaps of the days."""
    rows = completed(w.staging)
    names = rollup.dictionary(rows.select("merchant_name"))
    days = rollup.daily_bitmaps(rows, names, "transaction_date", "merchant_name", "account_id")
    month = F.trunc("transaction_date", "month")
    return rollup.distinct_in(materialize(days, "bitmaps"), month, "account_id")


@register
def lookback_from_sketch(w: Warehouse) -> DataFrame:
    return monitoring.lookback_from_sketch(materialize(monitoring.lag_sketch(w.bronze), "lags"))


def _monday_rates(w: Warehouse) -> DataFrame:
    """Rates of Mondays only, and none for the first days: the number of a day's rows."""
    rows = completed(w.staging).where("weekday(transaction_date) = 0")
    return rows.groupBy("currency", "transaction_date").agg(
        F.count("*").cast("decimal(10,4)").alias("rate")
    )


@register
def reporting_amounts_as_of(w: Warehouse) -> DataFrame:
    return monitoring.reporting_amounts_as_of(completed(w.staging), _monday_rates(w))


@register
def days_without_rate(w: Warehouse) -> DataFrame:
    return monitoring.days_without_rate(completed(w.staging), _monday_rates(w))


# Data tests.


def _test(name: str, build: Callable[[Warehouse], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(warehouse(spark, sf_dir))


_test("q_not_null", lambda w: quality.failing_rows(w.txn, "account_id", "not_null"))
_test("q_unique", lambda w: quality.failing_rows(w.bronze, "natural_key_hash", "unique"))
_test(
    "q_accepted_values",
    lambda w: quality.failing_rows(
        w.txn, "currency", "accepted_values", values=list(w.contract.currencies)
    ),
)
_test(
    "q_positive",
    lambda w: quality.failing_rows(
        load(w.spark, w.sf_dir, "customer"), "c_acctbal", "positive_value"
    ),
)
_test("q_non_negative", lambda w: quality.failing_rows(w.summary, "net_amount", "non_negative"))
_test(
    "q_unique_combination",
    lambda w: quality.unique_combination(
        load(w.spark, w.sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    ),
)
_test(
    "q_net_amount",
    lambda w: quality.net_amount_mismatch(w.summary).select("account_id", "transaction_date"),
)
_test("q_reconcile", lambda w: quality.reconciliation(w.staging, w.summary))
_test(
    "quality_suite",
    lambda w: quality.run_suite(
        w.spark,
        quality.DEFAULT_SUITE,
        {"stg_transactions": w.staging, "daily_account_summary": w.summary},
    ),
)


# Signals.


@register
def schema_drift(w: Warehouse) -> DataFrame:
    return monitoring.schema_drift(payloads(w.spark, w.sf_dir), w.contract)


@register
def quarantine_rate_alerts(w: Warehouse) -> DataFrame:
    return monitoring.quarantine_rate_alerts(w.daily_runs).select(
        "run_id", F.round("rate", 9).alias("rate"), F.round("baseline", 9).alias("baseline"), "alert"
    )


@register
def duplicate_rate_steps(w: Warehouse) -> DataFrame:
    return monitoring.duplicate_rate_steps(w.daily_runs).select(
        "run_id", F.round("rate", 9).alias("rate"), F.round("baseline", 9).alias("baseline"), "alert"
    )


@register
def new_reasons(w: Warehouse) -> DataFrame:
    store, _ = w.two_loads
    quarantine = store.quarantine.read()
    return monitoring.new_reasons(
        quarantine.where("ingestion_run_id = 'load-2'"),
        quarantine.where("ingestion_run_id <> 'load-2'"),
    )


@register
def volume_anomalies(w: Warehouse) -> DataFrame:
    found = monitoring.volume_anomalies(monitoring.daily_counts(w.bronze))
    return found.select(
        "day",
        "row_count",
        F.round("mean", 6).alias("mean"),
        F.round("spread", 6).alias("spread"),
        "anomaly",
    )


@register
def run_health(w: Warehouse) -> DataFrame:
    return monitoring.run_health(w.daily_runs, AS_OF)


@register
def lookback_from_lag(w: Warehouse) -> DataFrame:
    return monitoring.lookback_from_lag(w.bronze)


@register
def usual_days(w: Warehouse) -> DataFrame:
    """The window of dates that the records themselves call for."""
    return outliers.usual_days(outliers.day_counts(w.txn))


@register
def v_ts_learned_window(w: Warehouse) -> DataFrame:
    """The window check with that window in place of the fixed one."""
    learned = outliers.learned_contract(w.contract, outliers.day_counts(w.txn))
    check = next(c for c in field_checks(learned, text_view(learned)) if c.field == "transaction_date")
    code = f"outside_expected_window_{outliers.LEARNED_LABEL}"
    return w.txn.where(check.problem == label("transaction_date", code)).select(
        "transaction_id", F.col("transaction_date").alias("value"), check.text.alias("violation")
    )


@register
def amount_outliers(w: Warehouse) -> DataFrame:
    """Amounts far from the middle half of their currency and type, from sketches of days."""
    groups = ["currency", "transaction_type"]
    dated = w.bronze.withColumn("day", F.col("transaction_date").cast("date"))
    days = materialize(rollup.daily_sketch(dated, "day", F.col("amount"), *groups), "amounts")
    found = outliers.unusual_amounts(
        w.bronze, outliers.usual_amounts(days, *groups), F.col("amount"), groups
    )
    return found.select(
        "transaction_id", *groups, "amount", F.round("low", 6).alias("low"), F.round("high", 6).alias("high")
    )


@register
def reporting_amounts(w: Warehouse) -> DataFrame:
    """Converted with a rate per currency and day: the number of that day's rows."""
    rows = completed(w.staging)
    rates = rows.groupBy("currency", "transaction_date").agg(
        F.count("*").cast("decimal(10,4)").alias("rate")
    )
    return monitoring.reporting_amounts(rows, rates)
