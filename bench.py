"""Headline queries on one data folder; prints one JSON line.

Every query is run once to warm up and then timed; the result is consumed in
full without leaving the executors.  The stored tables a query reads are
written before its clock starts, as they are in a warehouse.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.ingest import run_ingest
from ledgerline.plans.registry import QUERIES
from ledgerline.plans.warehouse import AS_OF, warehouse
from ledgerline.session import tune_session
from ledgerline.sources.landing import read_landing

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "validate_all",
    "validate_payloads",
    "route_valid",
    "route_quarantine",
    "quarantine_reasons",
    "natural_key_hash",
    "flag_duplicates",
    "duplicate_pairs",
    "lineitem_duplicates",
    "upsert_merge",
    "incremental_scan",
    "stg_transactions",
    "daily_account_summary",
    "mart_left_join",
    "top_category",
    "table_checksum",
    "quality_suite",
    "reporting_amounts",
]


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def consume(result: DataFrame) -> None:
    result.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune_session(spark)
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        consume(QUERIES[name](spark, SF_DIR))
        seconds[name] = timed(lambda name=name: consume(QUERIES[name](spark, SF_DIR)))

    tables = warehouse(spark, SF_DIR)
    records = tables.landed.count()
    for name in ("ingest_run_cold", "ingest_run"):
        store = tables._new_store("bench")
        seconds[name] = timed(
            lambda store=store: run_ingest(
                tables.landed, store, tables.contract, summary=True, as_of=AS_OF
            )
        )
    # What is new after a first delivery, and the same again as a replay.
    store = tables._new_store("increments")
    second = read_landing(spark, f"{tables.landing}/delivery=2")
    run_ingest(
        read_landing(spark, f"{tables.landing}/delivery=1"), store, tables.contract, as_of=AS_OF
    )
    for name in ("ingest_increment", "ingest_replay"):
        seconds[name] = timed(
            lambda: run_ingest(
                second, store, tables.contract, mode="incremental", summary=True, as_of=AS_OF
            )
        )
    print(
        json.dumps(
            {
                "metric": "total seconds over the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "records": records,
                "records_per_second": {
                    n: round(records / seconds[n])
                    for n in ("validate_all", "validate_payloads", "flag_duplicates", "ingest_run")
                },
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
