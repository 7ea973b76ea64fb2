"""The monitoring signals against brute force on small audits."""

from __future__ import annotations

import statistics
from datetime import datetime, timedelta
from decimal import Decimal

from helpers import bronze_frame, bronze_row, payload_frame, record

from ledgerline import schemas
from ledgerline.operators import monitoring
from ledgerline.operators.combine import side_by_side

START = datetime(2024, 5, 1, 6)


def audit(spark, runs):
    """Runs a day apart: fetched, quarantined, duplicates, new rows, seconds, status, mark day."""
    rows = []
    for n, (fetched, bad, dup, new, seconds, status, mark) in enumerate(runs):
        begin = START + timedelta(days=n)
        values = {
            "run_id": f"r{n:02d}",
            "source_name": "s",
            "run_mode": "full",
            "started_at": begin,
            "ended_at": begin + timedelta(seconds=seconds),
            "status": status,
            "records_fetched": fetched,
            "records_valid": fetched - bad,
            "records_quarantined": bad,
            "records_duplicate_flagged": 400,
            "records_new": new,
            "records_duplicate_in_batch": dup,
            "new_watermark": None if mark is None else datetime(2024, 5, mark),
        }
        rows.append(tuple(values.get(c) for c in schemas.RUNS.fieldNames()))
    return spark.createDataFrame(rows, schemas.RUNS)


# From a Wednesday on: r03 and r04 fall on a weekend.
RUNS = [
    (1000, 1, 5, 999, 10, "success", 1),
    (1000, 2, 5, 998, 12, "success", 2),
    (1000, 9, 5, 0, 11, "success", 2),
    (0, 0, 0, 0, 1, "success", 3),
    (1000, 30, 50, 900, 40, "failed", None),
    (1000, 1, 5, 999, 10, "success", 4),
    (10, 10, 0, 0, 10, "success", 4),
    (1000, 1, 5, 10, 10, "success", 4),
    (1000, 1, 5, 10, 10, "success", 4),
    (1000, 1, 5, 0, 10, "success", 4),
]


def alerts(frame, name="alert"):
    return {r["run_id"] for r in frame.collect() if r[name]}


def test_rates(spark):
    runs = audit(spark, RUNS)
    rates = [b / f if f else None for f, b, *_ in RUNS]
    expected = set()
    for n, rate in enumerate(rates):
        past = [r for r in rates[max(0, n - 7) : n] if r is not None]
        if rate is not None and (rate > 0.02 or (past and rate > 3 * statistics.mean(past))):
            expected.add(f"r{n:02d}")
    assert alerts(monitoring.quarantine_rate_alerts(runs)) == expected == {"r02", "r04", "r06"}
    assert alerts(monitoring.duplicate_rate_steps(runs)) == {"r04"}


def test_run_health(spark):
    end = START + timedelta(days=9)
    health = monitoring.run_health(audit(spark, RUNS), end + timedelta(hours=27))
    assert alerts(health, "failed") == {"r04"}
    assert alerts(health, "slow") == {"r04"}
    # r02 is a replay and brings nothing new; r07 and r08 bring rows and nothing moves.
    assert alerts(health, "stuck_watermark") == {"r08"}
    # r03 is empty on a Saturday; r06 quarantined all it fetched on a Tuesday.
    assert alerts(health, "zero_rows") == {"r06"}
    assert len(alerts(health, "stale_source")) == len(RUNS)
    fresh = monitoring.run_health(audit(spark, RUNS), end + timedelta(hours=20))
    assert alerts(fresh, "stale_source") == set()


def test_a_full_load_and_its_replay_are_healthy(spark):
    """The duplicates of the whole table stand in both runs, those of the batch only once."""
    runs = audit(spark, [(352, 3, 5, 349, 8, "success", 30), (15, 2, 0, 0, 2, "success", 30)])
    assert alerts(monitoring.duplicate_rate_steps(runs)) == set()
    assert alerts(monitoring.run_health(runs, START), "stuck_watermark") == set()
    assert alerts(monitoring.quarantine_rate_alerts(runs)) == {"r01"}


def test_volume(spark):
    counts = [(START.date() + timedelta(days=n), 100 + n % 3) for n in range(25)]
    counts.append((START.date() + timedelta(days=25), 500))
    missing = counts.pop(20)[0]
    frame = spark.createDataFrame(counts, "day date, row_count bigint")
    rows = {r["day"]: r for r in monitoring.volume_anomalies(frame).collect()}
    assert len(rows) == 26 and rows[missing]["row_count"] == 0
    assert {d for d, r in rows.items() if r["anomaly"]} == {missing, counts[-1][0]}
    past = [100 + n % 3 for n in range(20)] + [0]
    assert abs(rows[missing + timedelta(days=1)]["mean"] - statistics.mean(past)) < 1e-9


def test_lookback_covers_the_share(spark):
    stamp = datetime(2024, 3, 1)
    lags = [0.5] * 97 + [1.5, 1.5, 9.0]
    rows = [
        bronze_row(
            f"T{n}", transaction_date=stamp - timedelta(days=lag), ingestion_timestamp=stamp
        )
        for n, lag in enumerate(lags)
    ]
    frame = bronze_frame(spark, rows)
    assert monitoring.lookback_from_lag(frame).first()[0] == 2
    assert monitoring.lookback_from_lag(frame, 1.0).first()[0] == 9
    assert monitoring.lookback_from_lag(frame, 0.97).first()[0] == 1


def test_drift_and_new_reasons(spark, contract):
    frame = payload_frame(spark, [record(x=1), record(x=2, y=None), record(id=1), "[1]"])
    drift = monitoring.schema_drift(frame, contract).collect()
    assert {tuple(r) for r in drift} == {("x", 2), ("y", 1)}
    batch = spark.createDataFrame([("a",), ("b",), ("b",)], "error_reason string")
    history = spark.createDataFrame([("a",), ("a",)], "error_reason string")
    assert [r[0] for r in monitoring.new_reasons(batch, history).collect()] == ["b"]


def test_reporting_currency(spark):
    rows = spark.createDataFrame(
        [
            ("A", START.date(), "USD", "credit", Decimal("10.00")),
            ("A", START.date(), "USD", "debit", Decimal("4.00")),
            ("A", START.date(), "EUR", "debit", Decimal("1.00")),
            ("A", START.date(), "JPY", "debit", Decimal("1.00")),
        ],
        "account_id string, transaction_date date, currency string, transaction_type string, "
        "amount decimal(18,2)",
    )
    rates = spark.createDataFrame(
        [("USD", START.date(), Decimal("0.5")), ("EUR", START.date(), Decimal("2"))],
        "currency string, transaction_date date, rate decimal(10,4)",
    )
    (row,) = monitoring.reporting_amounts(rows, rates).collect()
    assert row["net_reporting_amount"] == Decimal("1.00")
    assert row["currencies_without_rate"] == 1


def test_combining(spark):
    one, two = spark.range(3).selectExpr("count(*) AS a"), spark.range(1).selectExpr("7 AS b")
    assert tuple(side_by_side(one, two).first()) == (3, 7)
