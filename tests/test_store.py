"""Commits, filters and aggregates of the stored tables, and the gate before publishing."""

from __future__ import annotations

import json
import os
import random
from datetime import datetime

import pytest
from helpers import payload_frame, record
from pyspark.sql import functions as F

from ledgerline import ingest, schemas
from ledgerline.ingest import PublishBlocked, rebuild_summary, run_ingest, upsert_bronze
from ledgerline.operators.checksum import SUMMARY_CONTENT
from ledgerline.operators.id_filter import id_filters, may_hold, merged, size_for
from ledgerline.sources import store as stores
from ledgerline.sources.store import CommitConflict, CommitLog, DailyTable, LogTable, Store
from ledgerline.streaming.ingest_stream import start_ingest_stream


def txn(number, day, **changes):
    return record(
        transaction_id=f"TXN-{number:04d}",
        transaction_date=f"2024-02-{day:02d}T10:00:00Z",
        merchant_name=f"shop {number}",
        **changes,
    )


def load(spark, store, contract, records, **options):
    return run_ingest(payload_frame(spark, records), store, contract, **options).first()


def stored(store):
    return sorted((r["transaction_id"], r["status"], str(r["transaction_date"])[:10]) for r in store.bronze.read().collect())


def summary(store):
    return sorted(map(tuple, store.summary.read().select(*SUMMARY_CONTENT).collect()))


def test_of_two_writers_the_second_fails_and_changes_nothing(spark, store, contract):
    load(spark, store, contract, [txn(1, 1)])
    before, stage = stored(store), ingest.stage_quarantine

    def other_first(*args):
        pending = stage(*args)
        if not store.runs.current().where("run_id = 'other'").count():
            load(spark, store, contract, [txn(2, 2)], run_id="other")
        return pending

    with pytest.MonkeyPatch.context() as patch, pytest.raises(CommitConflict):
        patch.setattr(ingest, "stage_quarantine", other_first)
        load(spark, store, contract, [txn(1, 1, status="failed"), txn(3, 3)], run_id="late")
    assert stored(store) == [*before, ("TXN-0002", "completed", "2024-02-02")]
    audit = {r["run_id"]: r["status"] for r in store.runs.current().collect()}
    assert audit["late"] == "failed" and audit["other"] == "success"
    load(spark, store, contract, [txn(1, 1, status="failed"), txn(3, 3)])
    assert len(stored(store)) == 3


def test_a_thousand_commits_are_read_from_a_few_files(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "commits"))
    expected = {}
    for n in range(1000):
        day = f"d{n % 7}"
        expected["t", day] = n
        assert log.put(n, [{"table": "t", "day": day, "folder": str(n)}]) == n + 1
    assert {k: int(v["folder"]) for k, v in log.state().items()} == expected
    assert len(log.files()) <= stores.CHECKPOINT_EVERY
    assert len([f for f in os.listdir(log.path) if not f.startswith(".")]) <= 3 * stores.CHECKPOINT_EVERY
    with pytest.raises(CommitConflict):
        log.put(999, [{"table": "t", "day": "x", "folder": "y"}])
    assert log.version() == 1000 and ("t", "x") not in log.state()


def test_logs_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "CHECKPOINT_EVERY", 4)
    table = LogTable(spark, str(tmp_path / "runs"), schemas.WATERMARK, "source_name")
    assert table.current().count() == 0
    for n in range(14):
        table.append([{"source_name": f"s{n % 3}", "records_ingested": n, "last_run_at": datetime(2024, 1, 1, 0, 0, n, n)}])
    rows = {r["source_name"]: (r["records_ingested"], r["last_run_at"]) for r in table.current().collect()}
    assert rows == {f"s{n % 3}": (n, datetime(2024, 1, 1, 0, 0, n, n)) for n in (11, 12, 13)}
    assert len(table.files()) <= 4
    with pytest.raises(ValueError, match="source_name"):
        table.current("run_id")


def test_filters_miss_no_id_and_pass_few_others(spark):
    rows = spark.range(20_000).select(
        (F.col("id") % 3).cast("string").alias("day"), F.concat(F.lit("id "), "id").alias("key")
    )
    sizes = rows.groupBy("day").agg(size_for(F.count("*")).alias("size"))
    filters = id_filters(rows.join(sizes, "day"), "day", "key")
    known = [r["size"] for r in sizes.select("size").distinct().collect()]
    hits = may_hold(filters, rows.select("key").unionAll(spark.sql("SELECT CAST(NULL AS STRING)")), "day", "key", known)
    assert rows.join(hits, ["day", "key"], "left_anti").count() == 0
    others = spark.range(50_000).select(F.concat(F.lit("other "), "id").alias("key"))
    assert may_hold(filters, others, "day", "key", known).count() <= 3
    # A filter of all days is the days' filters merged.
    whole = merged(filters.withColumn("day", F.lit("all")), "day")
    assert may_hold(whole, rows.select("key"), "day", "key", known).select("key").distinct().count() == 20_000


def test_new_ids_read_no_other_day_and_moved_ones_are_found(spark, store, contract, monkeypatch):
    load(spark, store, contract, [txn(n, n) for n in range(1, 9)])
    read, seen = DailyTable.read_with_day, []

    def spy(self, days=None):
        seen.append(None if days is None else sorted(days))
        return read(self, days)

    monkeypatch.setattr(DailyTable, "read_with_day", spy)
    load(spark, store, contract, [txn(20, 3), txn(21, 12)])
    assert None not in seen  # nothing reads the whole table
    assert {d for days in seen for d in days if d.startswith("2024")} == {"2024-02-03", "2024-02-12"}
    seen.clear()
    load(spark, store, contract, [txn(5, 12)])
    assert {d for days in seen for d in days if d.startswith("2024")} == {"2024-02-05", "2024-02-12"}
    monkeypatch.undo()
    assert ("TXN-0005", "completed", "2024-02-12") in stored(store) and len(stored(store)) == 10
    assert store.bronze.days_that_may_hold(spark.createDataFrame([("TXN-0005",), (None,)], "transaction_id string")) == ["2024-02-12"]


def test_aggregates_follow_the_rows(spark, store, contract):
    def check():
        rows = store.bronze.read()
        whole = rows.agg(F.count("*"), F.count_if("is_duplicate"), F.max("transaction_date")).first()
        newest = store.bronze.greatest("newest")
        assert (store.bronze.total("rows"), store.bronze.total("duplicates")) == tuple(whole[:2])
        assert (newest and datetime.fromisoformat(newest)) == whole[2]

    first = [txn(1, 1), txn(2, 2), {**txn(2, 2), "transaction_id": "TXN-0009"}, txn(3, 5)]
    report = load(spark, store, contract, first)
    assert report["records_duplicate_flagged"] == 1
    check()
    load(spark, store, contract, first)  # replayed
    check()
    load(spark, store, contract, [txn(3, 4), txn(9, 2)])  # a day is left empty, a duplicate replaced
    assert "2024-02-05" not in dict(store.bronze._current())
    check()
    run = store.runs.current().orderBy(F.desc("started_at")).first()
    assert (run["records_valid"], run["records_new"], run["records_duplicate_flagged"]) == (2, 0, 0)
    # The watermark does not move back with the rows.
    assert run["new_watermark"] == datetime(2024, 2, 5, 10)


def test_a_failing_reconciliation_is_not_published(spark, store, contract, monkeypatch):
    load(spark, store, contract, [txn(1, 1), txn(2, 2)], summary=True, run_id="good")
    before = (stored(store), summary(store), store.quarantine.read().count())
    merge = ingest.merged_summary
    monkeypatch.setattr(ingest, "merged_summary", lambda *a: merge(*a).where("account_id <> 'ACC-0001'"))
    batch = [txn(1, 1, amount="5.00"), txn(3, 2, account_id="ACC-0001"), txn(4, 2, currency="usd")]
    with pytest.raises(PublishBlocked, match="summary_totals_match_source"):
        load(spark, store, contract, batch, summary=True, run_id="bad")
    assert (stored(store), summary(store), store.quarantine.read().count()) == before
    runs = {r["run_id"]: r for r in store.runs.current().collect()}
    assert runs["bad"]["status"] == "blocked" and "summary_totals" in runs["bad"]["error_message"]
    assert ingest.current_watermark(store, "landing.transactions") == datetime(2024, 2, 2, 10)
    held = [f for f in os.listdir(store.bronze.path) if f.startswith("write=")]
    assert len(held) == 1  # what was written is gone
    monkeypatch.undo()
    load(spark, store, contract, batch, summary=True)
    assert len(stored(store)) == 3 and store.quarantine.read().count() == 1


def test_drift_and_own_tests_can_block(spark, store, contract):
    drifted = [{**txn(1, 1), "note": "x"}, txn(2, 2)]
    with pytest.raises(PublishBlocked, match="schema_drift"):
        load(spark, store, contract, drifted, on_drift="fail")
    assert store.bronze.read().count() == 0
    assert load(spark, store, contract, drifted)["records_quarantined"] == 1
    with pytest.raises(PublishBlocked, match="too few rows"):
        load(spark, store, contract, [txn(3, 3)], before_publish=lambda p: ["too few rows"] * (p["bronze"].total("rows") < 2))
    with pytest.raises(ValueError, match="on_drift"):
        load(spark, store, contract, [], on_drift="ignore")


def test_only_changed_account_days_are_computed_again(spark, store, contract):
    early, late = datetime(2024, 3, 1), datetime(2024, 3, 2)
    first = [txn(n, 1 + n % 2, account_id=f"ACC-{n:04d}") for n in range(6)]
    load(spark, store, contract, first, summary=True, as_of=early)
    moved = [{**txn(0, 1, account_id="ACC-0000"), "amount": "9.99"}, txn(7, 1, account_id="ACC-0007"), txn(5, 1, account_id="ACC-0005")]
    load(spark, store, contract, moved, summary=True, as_of=late)
    stamps = {(r["account_id"], str(r["transaction_date"])): r["updated_at"] for r in store.summary.read().collect()}
    assert {k for k, v in stamps.items() if v == late} == {
        ("ACC-0000", "2024-02-01"), ("ACC-0007", "2024-02-01"), ("ACC-0005", "2024-02-01"),
    }
    assert ("ACC-0005", "2024-02-02") not in stamps and len(stamps) == 7
    by_differences = summary(store)
    rebuild_summary(store, late)
    assert summary(store) == by_differences


@pytest.mark.parametrize("seed", [1, 2])
def test_differences_come_to_what_a_rebuild_gives(spark, store, contract, seed):
    """Also where some runs do not keep the summary, and rows turn into duplicates."""
    rng = random.Random(seed)
    for n in range(4):
        batch = {}
        for _ in range(12):
            number = rng.randrange(15)
            row = txn(
                number, rng.randint(1, 3), account_id=f"ACC-000{rng.randrange(3)}",
                amount=f"{rng.randint(1, 9)}.50", status=rng.choice(["completed", "completed", "failed"]),
                currency=rng.choice(["USD", "EUR"]), transaction_type=rng.choice(["debit", "credit"]),
                merchant_category=rng.choice(["groceries", "travel"]),
            )
            batch[number] = {**row, "merchant_name": f"shop {number % 4}"}
        load(spark, store, contract, list(batch.values()), summary=n != 1)
    by_differences = summary(store)
    rebuild_summary(store)
    assert summary(store) == by_differences and by_differences


def test_late_records_are_counted_by_run_and_stream_batch(spark, store, contract, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def deliver(name, records):
        (landing / name).write_text("".join(json.dumps(r) + "\n" for r in records))

    def drain():
        start_ingest_stream(store, str(landing), str(tmp_path / "ckpt"), contract, mode="incremental").awaitTermination()

    deliver("a.json", [txn(1, 20)])
    drain()
    no_date = {k: v for k, v in txn(5, 1).items() if k != "transaction_date"}
    deliver("b.json", [txn(2, 3), txn(3, 4), txn(4, 19), no_date])
    drain()
    runs = [r["records_late_rejected"] for r in store.runs.current().orderBy("run_id").collect()]
    assert runs == [0, 2]
    report = load(spark, store, contract, [txn(6, 2)], mode="incremental")
    assert (report["records_fetched"], report["records_late_rejected"]) == (0, 1)


def test_upsert_without_a_run(spark, store, contract):
    load(spark, store, contract, [txn(1, 1), txn(2, 2)])
    days, replaced = upsert_bronze(store, store.bronze.read().where("transaction_id = 'TXN-0002'"), "fail")
    assert (days, replaced) == (["2024-02-02"], 1) and len(stored(store)) == 2


@pytest.mark.parametrize(("few_ids", "n_replaced"), [(100, 0), (100, 3), (100, 6), (2, 4), (0, 6), (0, 3)])
def test_ids_tell_what_a_batch_replaces(spark, store, contract, monkeypatch, few_ids, n_replaced):
    """None, some or all of the stored rows go: no stored row is shuffled, unless many go and stay."""
    bad = [txn(n, 1, currency="usd") for n in (50, 51)]
    load(spark, store, contract, [txn(n, 1) for n in range(6)] + bad)
    staged, plans = Store.staged, []

    def spied(self, rows, *by):
        if "source_payload" in rows.columns:
            plans.append(rows._jdf.queryExecution().sparkPlan().toString())
        return staged(self, rows, *by)

    monkeypatch.setattr(Store, "staged", spied)
    monkeypatch.setattr(ingest, "FEW_IDS", few_ids, raising=False)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")  # as if every table were large
    try:
        batch = [txn(n, 1, status="failed") for n in range(n_replaced)] + [txn(9, 1)]
        load(spark, store, contract, batch + bad[:1])
    finally:
        spark.conf.set(threshold, held)
    many = few_ids < min(n_replaced, 6 - n_replaced)
    assert [("SortMergeJoin" in p) for p in plans] == [many]
    assert {(i, s) for i, s, _ in stored(store)} == {
        (f"TXN-{n:04d}", "failed" if n < n_replaced else "completed") for n in (*range(6), 9)
    }
    assert store.bronze.read().count() == 7 and store.quarantine.read().count() == 2
