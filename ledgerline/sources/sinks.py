"""Exports: CSV with header, and small JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.combine import side_by_side
from ledgerline.operators.routing import reason_counts
from ledgerline.plans.reports import warehouse_summary
from ledgerline.sources.store import Store


def export_csv(rows: DataFrame, path: str) -> None:
    """Write CSV parts with a header line each; quotes are doubled, NULL is empty."""
    rows.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "emptyValue", '""'
    ).csv(path)


def export_json(document: DataFrame, path: str) -> None:
    """Write a one-row table as one JSON line, NULL members included."""
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_summary(
    flagged: DataFrame, quarantine: DataFrame, summary: DataFrame, path: str
) -> None:
    """The summary document: ``counts`` as one JSON line, ``quarantine_reasons`` as one each."""
    export_json(warehouse_summary(flagged, quarantine, summary), f"{path}/counts")
    reason_counts(quarantine).write.mode("overwrite").json(f"{path}/quarantine_reasons")


def watermark_snapshot(store: Store, source: str) -> DataFrame:
    """One row: the stored watermark, the latest run and the table counts."""
    mark = store.watermark.current("source_name").where(F.col("source_name") == source)
    run = latest_run(store.runs.current("run_id"))
    flagged = F.count_if("is_duplicate").alias("raw_transactions_flagged_duplicate")
    bronze = store.bronze.read().agg(F.count("*").alias("raw_transactions"), flagged)
    quarantine = store.quarantine.read().agg(F.count("*").alias("quarantine_transactions"))
    return side_by_side(
        mark.select(F.struct("*").alias("watermark_store")),
        run.select(F.struct("*").alias("last_run")),
        side_by_side(bronze, quarantine).select(F.struct("*").alias("table_counts")),
    )


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(1)
