"""One ingest run: check, route, upsert, flag, test, publish, record the run.

Batch loads and stream batches share this code.  A run writes its checked records once,
then only the days they touch, and tests what it wrote; one commit then publishes the
days of all tables.  A run that fails a test, or fails otherwise, leaves readers and the
watermark where they were and can simply be repeated.  Counts and the watermark come
from the write and from the commit list: no run reads the stored table for them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline import schemas
from ledgerline.contract import Contract
from ledgerline.functions.times import utc_literal
from ledgerline.operators.dedup import duplicate_groups, flag_duplicates, repeated_hashes
from ledgerline.operators.quality import RUN_SUITE, run_suite
from ledgerline.operators.routing import (
    DEFAULT_SOURCE,
    bronze_rows,
    check_payloads,
    is_valid,
    quarantine_rows,
)
from ledgerline.operators.upsert import assert_unique, latest_per_key, upsert
from ledgerline.plans.staging import completed, stg_transactions
from ledgerline.plans.summary import daily_account_summary, merged_summary, summary_changes
from ledgerline.sources.landing import requested_from as request_start
from ledgerline.sources.landing import read_landing, since
from ledgerline.sources.files import subfolders
from ledgerline.sources.store import DAY, DailyTable, Pending, Store

# Days outside these years share labels, so there are never more labels than days here.
FIRST_YEAR, LAST_YEAR = 1970, 2099
UNDATED = "undated"
UNEXPECTED = ": unexpected_field"  # how the violation of a member outside the contract ends
# So many ids at most are brought to the stored rows by broadcast: some 150 MB of long ones.
FEW_IDS = 1_000_000


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_run_id(started_at: datetime) -> str:
    return f"{started_at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"


def one_row(spark: SparkSession, schema: StructType, values: dict[str, Any]) -> DataFrame:
    return spark.createDataFrame([tuple(values.get(n) for n in schema.fieldNames())], schema)


def current_watermark(store: Store, source: str) -> datetime | None:
    rows = (
        store.watermark.current("source_name")
        .where(F.col("source_name") == source)
        .select("watermark_value")
        .collect()
    )
    return rows[0][0] if rows else None


def _day_label(day: Column) -> Column:
    usual = F.year(day).between(FIRST_YEAR, LAST_YEAR)
    return F.when(usual, day.cast("string")).otherwise(UNDATED)


def event_day() -> Column:
    """Day label of a bronze row; rows of one natural key share it, as the key holds the date."""
    return _day_label(F.col("transaction_date").cast("date"))


def quarantine_day() -> Column:
    """Day label of a quarantined payload.

    It depends on the payload alone, so a payload seen again falls into the
    same day.  Where the date is missing, unreadable or far off, the label is one of
    256 by the payload's key, so a run rewrites a small share of what is undated.
    """
    raw = F.get_json_object("raw_payload", "$.transaction_date")
    day = F.when(raw.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.substring(raw, 1, 10))
    label = _day_label(day.try_cast("date"))
    bucket = F.concat(F.lit(f"{UNDATED}-"), F.substring("quarantine_key", 1, 2))
    return F.when(label == UNDATED, bucket).otherwise(label)


def _days(rows: DataFrame) -> list[str]:
    """The distinct day labels: calendar days, so a short list whatever the row count."""
    return [r[0] for r in rows.select(DAY).distinct().collect()]


def _batch(rows: DataFrame, key: str, on_conflict: str) -> DataFrame:
    if on_conflict == "fail":
        assert_unique(rows, key)
        return rows
    if on_conflict == "latest":
        order = [c for c in ("transaction_date", "error_count") if c in rows.columns]
        return latest_per_key(rows, key, order)
    raise ValueError(f"on_conflict must be 'fail' or 'latest', not {on_conflict!r}")


@contextmanager
def upserted(
    store: Store, table: DailyTable, days: Sequence[str], batch: DataFrame, key: str
) -> Iterator[DataFrame]:
    """The stored rows of the days that the batch does not replace, and the batch.

    The same rows as :func:`upsert`.  Only ids are shuffled to find which stored rows the
    batch replaces.  Where that is all of them, none is read; where those that go, or
    those that stay, are few, their ids come to the stored rows by broadcast.  Stored rows are
    shuffled only where both are many.
    """
    stored = table.total("rows", days)
    target = table.read_with_day(days)
    if not stored:
        yield batch.select(target.columns)
        return
    ids = target.select(key)
    with store.staged(ids.join(batch.select(key), key, "left_semi")) as replaced:
        n_replaced = replaced.count()
        if n_replaced == stored:
            yield batch.select(target.columns)
        elif n_replaced <= FEW_IDS:
            kept = target.join(F.broadcast(replaced), key, "left_anti")
            yield kept.unionByName(batch)
        elif stored - n_replaced <= FEW_IDS:
            with store.staged(ids.join(replaced, key, "left_anti")) as staying:
                stays = staying.select(F.col(key).alias("_staying"))
                kept = target.join(
                    F.broadcast(stays), F.col(key).eqNullSafe(F.col("_staying")), "left_semi"
                )
                yield kept.unionByName(batch)
        else:
            yield upsert(target, batch, key)


class PublishBlocked(RuntimeError):
    """What a run wrote failed a test; nothing of it was published."""


def stage_bronze(store: Store, valid: DataFrame, on_conflict: str, **more: Column) -> Pending:
    """Write the days the batch touches, upserted and flagged again.

    A replaced row may sit on another day than its new version.  The days that may hold
    one are found by their filters; only ids of these days are read, and only days that
    do change are then read in full and written again.
    """
    table = store.bronze
    batch = _batch(valid, "transaction_id", on_conflict).withColumn(DAY, event_day())
    batch_days = _days(batch)
    possible = table.days_that_may_hold(batch, beside=batch_days) if batch_days else []
    moved_from: list[str] = []
    if possible:
        ids = table.read_with_day(possible).select("transaction_id", DAY)
        moved_from = _days(ids.join(batch.select("transaction_id"), "transaction_id", "left_semi"))
    days = sorted({*batch_days, *moved_from})
    # Flagging reads its input twice, once only a few columns of it.  Where groups are few,
    # rows are shuffled once, to the files of their day.
    key = "transaction_id"
    with upserted(store, table, days, batch, key) as merged, store.staged(merged) as staged:
        with (
            store.staged(repeated_hashes(staged)) as repeated,
            store.staged(duplicate_groups(staged, repeated=repeated)) as groups,
        ):
            return table.stage(flag_duplicates(staged, groups=groups), days, **more)


def upsert_bronze(store: Store, valid: DataFrame, on_conflict: str) -> tuple[list[str], int]:
    """Upsert and re-flag the days the batch touches; returns those days and the rows replaced."""
    version = store.log.version()
    pending = stage_bronze(store, valid, on_conflict)
    replaced = _replaced(store, pending, valid.count())
    store.publish([pending], version)
    return list(pending.days), replaced


def _replaced(store: Store, pending: Pending, n_valid: int) -> int:
    """Rows of the batch that were stored before, by the counts of the days."""
    before = store.bronze.total("rows", pending.days)
    return before + n_valid - pending.total("rows")


def stage_quarantine(store: Store, invalid: DataFrame, on_conflict: str) -> Pending:
    table = store.quarantine
    batch = _batch(invalid, "quarantine_key", on_conflict).withColumn(DAY, quarantine_day())
    days = _days(batch)
    with upserted(store, table, days, batch, "quarantine_key") as merged:
        return table.stage(merged, days)


def upsert_quarantine(store: Store, invalid: DataFrame, on_conflict: str) -> None:
    version = store.log.version()
    store.publish([stage_quarantine(store, invalid, on_conflict)], version)


def stage_summary(store: Store, bronze: Pending, as_of: datetime | None = None) -> Pending:
    """Write the summary of the days that ``bronze`` replaces, from what changes in them.

    Rows that are there before and after alike cancel out.  Sums and counts of the
    account-days of the others are moved by the difference; what cannot be taken back
    from a sum is computed again for these account-days only.  All others are copied.
    """
    state = store.log.state()
    of = lambda table, day, part: state.get((table, day), {}).get(part)
    # A day's summary can be moved only if it was made of what the day holds now.
    moved = [d for d in bronze.days if of("summary", d, "of") == of("bronze", d, "folder")]
    whole = [d for d in bronze.days if d not in set(moved)]
    fresh = bronze.read().where(F.col(DAY).isin(whole)).select(schemas.BRONZE.fieldNames())
    rebuilt = daily_account_summary(stg_transactions(fresh), as_of)
    before = stg_transactions(store.bronze.read(moved))
    after = stg_transactions(
        bronze.read().where(F.col(DAY).isin(moved)).select(schemas.BRONZE.fieldNames())
    )
    with store.staged(summary_changes(before, after)) as changes:
        merged = merged_summary(store.summary.read(moved), changes, after, as_of)
        rows = merged.unionByName(rebuilt) if whole else merged
        return store.summary.stage(
            rows.withColumn(DAY, _day_label(F.col("transaction_date"))), bronze.days, of=bronze.made()
        )


def refresh_summary(store: Store, days: Sequence[str], as_of: datetime | None = None) -> None:
    """Rebuild the summary of the given days only."""
    made = dict(store.bronze._current(days))
    staging = stg_transactions(store.bronze.read(days))
    summary = daily_account_summary(staging, as_of)
    store.summary.replace(
        summary.withColumn(DAY, _day_label(F.col("transaction_date"))), days, of=made
    )


def audit_failures(
    store: Store, pending: Mapping[str, Pending], suite: Mapping[str, Any], drift: bool
) -> list[str]:
    """The tests that the written days fail, by name."""
    spark = store.spark
    bronze = pending["bronze"]
    staging = stg_transactions(bronze.read().select(schemas.BRONZE.fieldNames()))
    tables = {"stg_transactions": staging}
    if "summary" in pending:
        tables["daily_account_summary"] = pending["summary"].read()
    known = lambda test: set(test.get("needs", ())) <= set(tables)
    wanted = {
        "models": [m for m in suite.get("models", []) if m["name"] in tables],
        "data_tests": [t for t in suite.get("data_tests", []) if known(t)],
    }
    failed = ["schema_drift"] if drift else []
    if any(wanted.values()):
        results = run_suite(spark, wanted, tables).where(~F.col("passed")).collect()
        failed += sorted(f"{r['test']} ({r['failures']})" for r in results)
    return failed


def rebuild_summary(store: Store, as_of: datetime | None = None) -> None:
    """Full refresh of the summary."""
    days = [day for day, _ in {*store.bronze._current(), *store.summary._current()}]
    refresh_summary(store, days, as_of)


def run_ingest(
    records: DataFrame,
    store: Store,
    contract: Contract,
    mode: str = "full",
    lookback_days: int = 2,
    source: str = DEFAULT_SOURCE,
    on_conflict: str = "fail",
    summary: bool = False,
    reset: bool = False,
    run_id: str | None = None,
    as_of: datetime | None = None,
    suite: Mapping[str, Any] | None = RUN_SUITE,
    on_drift: str = "report",
    before_publish: Callable[[Mapping[str, Pending]], Sequence[str]] | None = None,
) -> DataFrame:
    """Load raw records (one JSON text per row, ``payload``) and return a one-row report.

    ``mode="full"`` takes every record; ``mode="incremental"`` takes those
    dated at or after the watermark less the lookback, or all of them when no
    watermark exists yet.  A payload that is no JSON object has no date to go by and
    is always taken, so it ends in quarantine in either mode; records dated before the
    window are counted as ``records_late_rejected``.  ``reset`` empties the store before a
    full load.

    What the run wrote is tested before it is published: by the data tests of ``suite``
    on the days it touches, by ``before_publish`` (which names further tests that fail),
    and, with ``on_drift="fail"``, for members outside the contract.  A failing test
    raises :class:`PublishBlocked`; readers keep the version they had and the audit says
    ``blocked``.  Of two runs at the same time the second one to publish fails with
    ``CommitConflict``.

    Every line is parsed once, into a staging table.  What has been loaded before is
    best not handed in at all: see :func:`ingest_deliveries`.
    """
    if reset and mode != "full":
        raise ValueError("only a full load can reset the store")
    if mode not in ("full", "incremental"):
        raise ValueError(f"mode must be 'full' or 'incremental', not {mode!r}")
    if on_drift not in ("report", "fail"):
        raise ValueError(f"on_drift must be 'report' or 'fail', not {on_drift!r}")
    spark = store.spark
    if reset:
        store.reset()
    started_at = as_of or utc_now()
    run_id = run_id or new_run_id(started_at)
    version = store.log.version()
    previous = current_watermark(store, source)
    start = request_start(previous, lookback_days) if mode == "incremental" else None
    audit: dict[str, Any] = {
        "run_id": run_id,
        "source_name": source,
        "run_mode": mode,
        "requested_from": start,
        "started_at": started_at,
        "status": "running",
        "records_fetched": 0,
        "records_valid": 0,
        "records_quarantined": 0,
        "records_duplicate_flagged": 0,
        "records_late_rejected": 0,
        "previous_watermark": previous,
    }
    store.runs.append([audit])
    pending: dict[str, Pending] = {}
    try:
        def wanted(date: Column, is_object: Column) -> Column:
            return F.coalesce(since(date, utc_literal(start)) | ~is_object, F.lit(False))

        rule = None if start is None else wanted
        checked = check_payloads(records, contract, rule).withColumn("ok", is_valid())
        # Parsing and checking happen once; everything after reads the result.  A filter
        # before this point would be pushed below the parse and repeat it, so what is not
        # taken passes by unchecked.
        seen = Observation()
        taken = F.lit(True)
        if start is not None:
            taken = wanted(F.col("transaction_date"), F.col("is_object"))
        late = ~taken & F.col("transaction_date").isNotNull()
        unknown = F.exists("violations", lambda v: v.endswith(UNEXPECTED))
        observed = checked.observe(
            seen,
            F.count_if(taken & F.col("ok")).alias("valid"),
            F.count_if(taken & ~F.col("ok")).alias("invalid"),
            F.count_if(late).alias("late"),
            F.count_if(taken & unknown).alias("drift"),
        )
        with store.staged(observed, "ok") as written:
            counts = seen.get
            staged = written.where(taken)
            audit["records_valid"] = counts["valid"]
            audit["records_quarantined"] = counts["invalid"]
            audit["records_fetched"] = counts["valid"] + counts["invalid"]
            audit["records_late_rejected"] = counts["late"]
            valid = bronze_rows(staged.where("ok"), contract, source, run_id, started_at)
            invalid = quarantine_rows(staged.where("NOT ok"), source, run_id, started_at)
            own = F.count_if(F.col("is_duplicate") & (F.col("ingestion_run_id") == run_id))
            pending["bronze"] = bronze = stage_bronze(store, valid, on_conflict, own=own)
            pending["quarantine"] = stage_quarantine(store, invalid, on_conflict)
        if summary:
            pending["summary"] = stage_summary(store, bronze, as_of)
        drift = on_drift == "fail" and counts["drift"] > 0
        failed = audit_failures(store, pending, suite or {}, drift)
        failed += before_publish(pending) if before_publish else []
        if failed:
            raise PublishBlocked("; ".join(failed))
        replaced = _replaced(store, bronze, counts["valid"])
        store.publish(list(pending.values()), version)

        # From the commit list: nothing of the table is read.
        duplicates, newest = store.bronze.total("duplicates"), store.bronze.greatest("newest")
        marks = [m for m in (previous, newest and datetime.fromisoformat(newest)) if m]
        mark = max(marks, default=None)
        ended_at = as_of or utc_now()
        store.watermark.append(
            [
                {
                    "source_name": source,
                    "watermark_value": mark,
                    "effective_request_from": start,
                    "last_run_id": run_id,
                    "last_run_at": ended_at,
                    "last_run_status": "success",
                    "records_ingested": audit["records_valid"],
                }
            ]
        )
        audit.update(
            status="success",
            ended_at=ended_at,
            records_duplicate_flagged=duplicates,
            records_new=audit["records_valid"] - replaced,
            records_duplicate_in_batch=bronze.total("own"),
            new_watermark=mark,
        )
    except Exception as error:
        for written in pending.values():
            written.discard()
        audit.update(
            status="blocked" if isinstance(error, PublishBlocked) else "failed",
            ended_at=as_of or utc_now(),
            error_message=f"{type(error).__name__}: {error}",
        )
        store.runs.append([audit])
        raise
    store.runs.append([audit])
    return _report(spark, audit, lookback_days if mode == "incremental" else 0)


def _report(spark: SparkSession, audit: dict[str, Any], lookback_days: int) -> DataFrame:
    def text(value: datetime | None) -> str | None:
        return value.isoformat() if value else None

    values = {
        **audit,
        "requested_from": text(audit["requested_from"]),
        "previous_watermark": text(audit["previous_watermark"]),
        "new_watermark": text(audit["new_watermark"]),
        "lookback_days": lookback_days,
        "duration_seconds": round((audit["ended_at"] - audit["started_at"]).total_seconds(), 3),
    }
    return one_row(spark, schemas.REPORT, values)


def pending_deliveries(store: Store, root: str) -> list[str]:
    """The folders below ``root`` that no run has loaded yet, by name."""
    loaded = {r["delivery"] for r in store.deliveries.current("delivery").collect()}
    return sorted(subfolders(store.spark, root) - loaded)


def ingest_deliveries(
    store: Store, root: str, contract: Contract, mode: str = "incremental", **options: Any
) -> DataFrame | None:
    """Load the delivery folders below ``root`` that are new, and remember them.

    Files of earlier deliveries are not opened.  The folders are remembered after
    the run, so a run that fails leaves them pending; loading one twice changes
    nothing.  Returns the run's report, or None where nothing is pending.  The driver
    holds the folder names.
    """
    pending = pending_deliveries(store, root)
    if not pending:
        return None
    records = read_landing(store.spark, [f"{root}/{name}" for name in pending])
    report = run_ingest(records, store, contract, mode=mode, **options)
    run_id = report.first()["run_id"]
    store.deliveries.append([{"delivery": name, "run_id": run_id} for name in pending])
    return report
