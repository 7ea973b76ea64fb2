"""Registered queries against their SQL counterparts, and the plans they run as."""

from __future__ import annotations

import re

import duckdb
import pytest
from conftest import TESTDATA
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as contract_module
from ledgerline.operators.dedup import flag_duplicates
from ledgerline.plans.oracles import ORACLES
from ledgerline.plans.registry import QUERIES
from ledgerline.plans.summary import daily_account_summary
from ledgerline.plans.warehouse import warehouse
from ledgerline.session import materialize, scratch_root

# The rest is compared the same way by the driver; these stand for every kind of query.
COMPARED = [
    "incremental_scan",
    "stable_page",
    "v_ts_calendar",
    "v_account_id",
    "validate_all",
    "validate_payloads",
    "payload_key",
    "route_quarantine",
    "quarantine_reasons",
    "natural_key_hash",
    "flag_duplicates",
    "duplicate_pairs",
    "lineitem_duplicates",
    "upsert_merge",
    "daily_account_summary",
    "mart_left_join",
    "table_checksum",
    "warehouse_summary",
    "quality_suite",
    "run_health",
    "reporting_amounts",
    "pipeline_summary",
    "ingest_incremental_payloads",
    "run_audit",
    "duplicate_steps_of_loads",
    "health_of_replays",
    "volume_anomalies",
    "q_net_amount",
    "duplicate_rate_steps",
    "quarantine_rate_alerts",
    "incremental_summary",
    "watermark_read",
    "upsert_indexed",
    "commit_aggregates",
    "blocked_publish",
    "ordered_export",
    "export_csv",
    "monthly_merchants",
    "lookback_from_sketch",
    "reporting_amounts_as_of",
    "days_without_rate",
    "usual_days",
    "v_ts_learned_window",
    "amount_outliers",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("events", "lineitem", "customer"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract_module.queries())
    assert ORACLES.items() <= contract_module.oracle_sql().items()
    assert set(COMPARED) <= set(QUERIES)


@pytest.mark.parametrize("name", COMPARED)
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, TESTDATA)
    columns = sorted(got.columns)
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    rows = [dict(zip(names, r, strict=True)) for r in expected.fetchall()]
    assert sorted(names) == columns
    assert sorted(repr([r[c] for c in columns]) for r in got.collect()) == sorted(
        repr([r[c] for c in columns]) for r in rows
    )


def executed(frame) -> str:
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_summary_plan_is_one_narrow_scan(spark):
    w = warehouse(spark, TESTDATA)
    plan = executed(daily_account_summary(w.staging))
    assert plan.count("FileScan") == 1
    assert plan.count(" Exchange ") == 3
    assert "source_payload" not in plan and "Join" not in plan
    scan = re.search(r"PushedFilters: \[[^\]]*\]", plan)[0]
    assert "EqualTo(status,completed)" in scan and "is_duplicate" in scan


def test_flags_need_no_window_and_prune_the_grouping(spark):
    bronze = warehouse(spark, TESTDATA).bronze
    plan = executed(flag_duplicates(bronze))
    assert "Window" not in plan and "partial_min" in plan
    narrow = "ReadSchema: struct<transaction_id:string,transaction_date:timestamp_ntz,natural_key_hash:string>"
    assert narrow in plan


def test_a_hot_group_is_spread_over_all_tasks(spark):
    """A third of the rows share a key; the wide join gives no task more than its share."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    rows = spark.range(60_000, numPartitions=8).selectExpr(
        "cast(id AS string) AS transaction_id",
        "1 AS transaction_date",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id DIV 4 AS string) END AS k",
    )
    rows = materialize(rows, "skew")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        largest = {}
        for hot_group_rows in (1_000, 10**9):
            flagged = flag_duplicates(rows, key="k", hot_group_rows=hot_group_rows)
            tasks = flagged.groupBy(F.spark_partition_id().alias("task")).agg(
                F.count("*").alias("n"), F.count_if("is_duplicate").alias("d")
            )
            sizes = [(r["n"], r["d"]) for r in tasks.collect()]
            duplicates = 60_000 - rows.select("k").distinct().count()
            assert sum(d for _, d in sizes) == duplicates
            largest[hot_group_rows] = max(n for n, _ in sizes)
        assert largest[1_000] < 60_000 / 8 * 1.2
        assert largest[10**9] > 20_000
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_scratch_follows_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_root(spark) == configured
    path = materialize(spark.range(3), "numbers").inputFiles()[0]
    assert configured in path
    with pytest.raises(PySparkException):
        spark.read.parquet(f"{configured}/nothing")


def test_landing_files_are_packed_and_bounded(spark, tmp_path, monkeypatch):
    from ledgerline.plans import warehouse as plans

    monkeypatch.setattr(plans, "FILE_LINES", 10)
    lines = spark.range(25, numPartitions=1).selectExpr("cast(id AS string) AS value", "1 AS delivery")
    plans._write_landing(lines, str(tmp_path / "landing"))
    files = [f.name for f in (tmp_path / "landing" / "delivery=1").iterdir() if f.name.startswith("part")]
    assert len(files) == 3 and all(f.endswith(".gz") for f in files)
    assert spark.read.text(str(tmp_path / "landing")).select("value").distinct().count() == 25
