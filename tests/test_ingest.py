from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pytest
from helpers import GOOD, payload_frame, record
from pyspark.sql import functions as F

from ledgerline.ingest import (
    _batch,
    current_watermark,
    event_day,
    ingest_deliveries,
    new_run_id,
    pending_deliveries,
    rebuild_summary,
    refresh_summary,
    run_ingest,
)
from ledgerline.operators.checksum import SUMMARY_CONTENT
from ledgerline.operators.routing import DEFAULT_SOURCE, check_payloads
from ledgerline.operators.upsert import BatchKeyConflict
from ledgerline.plans.reports import quarantine_listing
from ledgerline.sources.sinks import (
    export_csv,
    export_json,
    export_summary,
    latest_run,
    watermark_snapshot,
)
from ledgerline.streaming.ingest_stream import start_ingest_stream


def txn(number: int, day: str, **changes):
    return record(
        transaction_id=f"TXN-{number:04d}",
        transaction_date=f"2024-02-{day}T10:00:00Z",
        merchant_name=f"shop {number}",
        **changes,
    )


def load(spark, store, contract, records, **options):
    return run_ingest(payload_frame(spark, records), store, contract, **options).first()


def stored(store):
    return {
        r["transaction_id"]: (r["status"], r["is_duplicate"], str(r["transaction_date"])[:10])
        for r in store.bronze.read().collect()
    }


def test_full_load_report_audit_exports_and_replay(spark, store, contract, tmp_path):
    records = [
        txn(1, "01"),
        txn(2, "03"),
        {**txn(2, "03"), "transaction_id": "TXN-0009"},
        txn(3, "02", currency="usd", country_code='a "b", c'),
    ]
    report = load(spark, store, contract, records, lookback_days=5)
    assert report["status"] == "success" and report["run_mode"] == "full"
    assert (report["records_fetched"], report["records_valid"]) == (4, 3)
    assert (report["records_quarantined"], report["records_duplicate_flagged"]) == (1, 1)
    assert (report["previous_watermark"], report["new_watermark"]) == (None, "2024-02-03T10:00:00")
    assert report["lookback_days"] == 0 and report["requested_from"] is None
    assert stored(store)["TXN-0009"] == ("completed", True, "2024-02-03")

    (run,) = store.runs.current("run_id").collect()
    assert run["status"] == "success" and run["run_id"] == report["run_id"]
    assert run["records_duplicate_flagged"] == 1 and run["error_message"] is None
    (bad,) = store.quarantine.read().collect()
    assert bad["error_reason"] == (
        "currency: invalid_currency_code (got 'usd'); "
        "country_code: invalid_format (got 'a \"b\", c')"
    )
    assert bad["transaction_id"] == "TXN-0003" and bad["error_count"] == 2
    assert json.loads(bad["raw_payload"])["merchant_name"] == "shop 3"
    assert current_watermark(store, DEFAULT_SOURCE) == datetime(2024, 2, 3, 10)
    assert current_watermark(store, "another source") is None

    snapshot = watermark_snapshot(store, DEFAULT_SOURCE).first()
    assert snapshot["watermark_store"]["records_ingested"] == 3
    assert snapshot["last_run"]["run_id"] == report["run_id"]
    assert tuple(snapshot["table_counts"]) == (3, 1, 1)

    export_csv(quarantine_listing(store.quarantine.read()), str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, escape='"')
    assert back.columns[:3] == ["transaction_id", "error_count", "error_reason"]
    assert json.loads(back.first()["raw_payload"])["country_code"] == 'a "b", c'
    export_json(watermark_snapshot(store, DEFAULT_SOURCE), str(tmp_path / "json"))
    document = spark.read.json(str(tmp_path / "json")).first()
    assert document["table_counts"]["raw_transactions"] == 3
    assert document["last_run"]["status"] == "success"

    # The same records again: as many rows, newer stamps.
    before = stored(store)
    load(spark, store, contract, records, run_id="replay")
    assert stored(store) == before and store.quarantine.read().count() == 1
    for table in (store.bronze, store.quarantine):
        assert {r[0] for r in table.read().select("ingestion_run_id").collect()} == {"replay"}


def test_incremental_reads_the_lookback_only(spark, store, contract):
    first = load(spark, store, contract, [txn(1, "01"), txn(2, "10")], mode="incremental")
    assert first["run_mode"] == "incremental" and first["requested_from"] is None
    assert first["lookback_days"] == 2
    late = [
        txn(1, "01", status="failed"),  # before the lookback: not seen again
        txn(2, "10", status="failed"),  # replaced
        txn(3, "09"),  # one day late: taken
        txn(4, "05"),  # five days late: never seen
        txn(5, "08", currency="usd"),  # quarantined
        {**txn(6, "11"), "transaction_date": "2024-04-15 09:30:00"},  # malformed, sorts later
        {k: v for k, v in txn(7, "11").items() if k != "transaction_date"},  # no date
    ]
    second = load(spark, store, contract, late, mode="incremental")
    assert second["requested_from"] == "2024-02-08T10:00:00"
    assert (second["records_fetched"], second["records_valid"]) == (4, 2)
    assert second["previous_watermark"] == second["new_watermark"] == "2024-02-10T10:00:00"
    assert stored(store) == {
        "TXN-0001": ("completed", False, "2024-02-01"),
        "TXN-0002": ("failed", False, "2024-02-10"),
        "TXN-0003": ("completed", False, "2024-02-09"),
    }
    mark = store.watermark.current("source_name").first()
    assert mark["effective_request_from"] == datetime(2024, 2, 8, 10)
    assert latest_run(store.runs.current("run_id")).first()["run_id"] == second["run_id"]
    # A full load ignores the watermark, and the mark does not move back.
    third = load(spark, store, contract, [txn(8, "02")])
    assert third["records_fetched"] == 1 and third["requested_from"] is None
    assert third["new_watermark"] == "2024-02-10T10:00:00"


def test_corrupt_lines_are_quarantined_in_either_mode(spark, store, contract):
    load(spark, store, contract, [txn(1, "10")], mode="incremental")
    corrupt = ["no json", '["TXN-0002"]', '{"transaction_id": "TXN-0003"', json.dumps(txn(4, "11"))]
    report = load(spark, store, contract, corrupt, mode="incremental")
    assert (report["records_fetched"], report["records_quarantined"]) == (4, 3)
    assert {r["error_reason"] for r in store.quarantine.read().collect()} == {
        "payload: not_an_object"
    }
    run = store.runs.current("run_id").where(F.col("run_id") == report["run_id"]).first()
    assert (run["records_new"], run["records_duplicate_in_batch"]) == (1, 0)
    again = load(spark, store, contract, corrupt, mode="incremental")
    run = store.runs.current("run_id").where(F.col("run_id") == again["run_id"]).first()
    assert run["records_new"] == 0 and store.quarantine.read().count() == 3


def test_only_new_deliveries_are_opened(spark, store, contract, tmp_path):
    def deliver(name, *records):
        (tmp_path / "in" / name).mkdir(parents=True)
        lines = "".join(json.dumps(r) + "\n" for r in records)
        (tmp_path / "in" / name / "part.json").write_text(lines)

    root = str(tmp_path / "in")
    deliver("d1", txn(1, "01"), txn(2, "02"))
    assert ingest_deliveries(store, root, contract).first()["records_fetched"] == 2
    assert ingest_deliveries(store, root, contract) is None
    (tmp_path / "in" / "d1" / "part.json").write_text("what is loaded is not read again")
    deliver("d2", txn(3, "02"))
    deliver("d3", txn(2, "02", status="failed"))
    assert pending_deliveries(store, root) == ["d2", "d3"]
    assert ingest_deliveries(store, root, contract).first()["records_fetched"] == 2
    assert store.quarantine.read().count() == 0
    assert {t: s for t, (s, _, _) in stored(store).items()} == {
        "TXN-0001": "completed", "TXN-0002": "failed", "TXN-0003": "completed",
    }


def test_each_line_is_parsed_once(spark, store, contract, monkeypatch):
    """The records reach the staging table by one parse, and no filter stands before it.

    A second parse is there for payloads with fractional numbers only.
    """
    plans = []
    staged = type(store).staged

    def seen(self, rows, *partition_by):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return staged(self, rows, *partition_by)

    load(spark, store, contract, [txn(1, "01")], mode="incremental")
    monkeypatch.setattr(type(store), "staged", seen)
    load(spark, store, contract, [txn(2, "03")], mode="incremental")
    assert plans[0].count("parseJson(concat([") == 1 and "Filter" not in plans[0]


def test_replaced_folders_can_be_removed(spark, store, contract):
    for _ in range(3):
        load(spark, store, contract, [txn(1, "01"), txn(2, "02")])
    files = lambda: sum("2024-02" in d and "filters" not in d and any(f.startswith("part") for f in fs) for d, _, fs in os.walk(store.root))
    before = stored(store)
    assert files() == 6 and store.remove_replaced() == 0
    assert store.remove_replaced(older_than=0) == 4
    assert files() == 2 and stored(store) == before
    load(spark, store, contract, [txn(1, "01", status="failed")])
    assert stored(store)["TXN-0001"][0] == "failed"


def test_a_failed_run_leaves_no_staging(spark, store, contract, monkeypatch):
    load(spark, store, contract, [txn(1, "01")])

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr("ledgerline.sources.store.subfolders", lost)
    with pytest.raises(OSError, match="lost"):
        load(spark, store, contract, [txn(2, "01")])
    staging = os.path.join(store.root, "staging")
    assert not os.path.exists(staging) or os.listdir(staging) == []


def test_undated_quarantine_is_split_by_key(spark, store, contract):
    load(spark, store, contract, [f"no json {n}" for n in range(40)])
    labels = {d for d, _ in store.quarantine._current()}
    assert len(labels) > 20 and all(d.startswith("undated-") for d in labels)
    load(spark, store, contract, ["no json 7"])
    assert store.quarantine.read().count() == 40


def test_summary_document(spark, store, contract, tmp_path):
    bad = [txn(n, "01", currency="usd") for n in (1, 2)] + [txn(3, "01", status="done")]
    load(spark, store, contract, [*bad, txn(4, "02"), txn(5, "03")], summary=True)
    tables = (store.bronze.read(), store.quarantine.read(), store.summary.read())
    export_summary(*tables, str(tmp_path / "out"))

    def lines(name):
        folder = tmp_path / "out" / name
        return [json.loads(x) for f in folder.glob("part*") for x in f.read_text().splitlines()]

    assert lines("counts") == [
        {"raw_transactions": 2, "raw_flagged_duplicate": 0, "quarantined": 3,
         "daily_account_summary_rows": 2, "distinct_accounts": 1}
    ]
    reasons = {r["error_reason"]: r["record_count"] for r in lines("quarantine_reasons")}
    assert sorted(reasons.values()) == [1, 2]


def test_whole_and_fractional_numbers_are_two_payloads(spark, store, contract):
    """Both are quarantined and keep a row each, in one batch."""
    bad = [json.dumps({**GOOD, "amount": n}) for n in (-1, -1.0, 0.0, 0)]
    report = load(spark, store, contract, bad)
    assert report["records_quarantined"] == 4
    texts = {r["raw_payload"] for r in store.quarantine.read().collect()}
    assert texts == {json.dumps(json.loads(b), sort_keys=True, separators=(",", ":")) for b in bad}


def test_moved_rows_leave_their_old_day(spark, store, contract):
    """Only the days a run touches are summarised again, to the same effect as all of them."""
    load(spark, store, contract, [txn(n, f"{n:02d}") for n in (1, 2, 5)], summary=True)
    load(spark, store, contract, [txn(1, "05"), txn(7, "02", amount="7.77")], summary=True)
    assert stored(store)["TXN-0001"] == ("completed", False, "2024-02-05")
    assert store.bronze.read().count() == 4

    def summary():
        return sorted(map(tuple, store.summary.read().select(*SUMMARY_CONTENT).collect()))

    incremental = summary()
    assert [(str(r[1]), r[5]) for r in incremental] == [("2024-02-02", 2), ("2024-02-05", 2)]
    rebuild_summary(store)
    assert summary() == incremental
    refresh_summary(store, [])


def test_duplicates_are_flagged_across_batches(spark, store, contract):
    twin = {**txn(1, "01"), "transaction_id": "TXN-0000"}
    load(spark, store, contract, [txn(1, "01"), txn(2, "02")])
    report = load(spark, store, contract, [twin])
    assert report["records_duplicate_flagged"] == 1
    assert stored(store)["TXN-0001"][1] is True and stored(store)["TXN-0000"][1] is False
    # Replacing the survivor by something else frees its duplicate.
    report = load(spark, store, contract, [{**twin, "status": "failed"}])
    assert report["records_duplicate_flagged"] == 0


def test_failed_run_keeps_watermark_and_rows(spark, store, contract, monkeypatch):
    load(spark, store, contract, [txn(1, "01")], run_id="good")
    clash = [txn(2, "20"), txn(2, "21")]
    with pytest.raises(BatchKeyConflict):
        load(spark, store, contract, clash, run_id="bad")
    runs = {r["run_id"]: r for r in store.runs.current("run_id").collect()}
    assert runs["bad"]["status"] == "failed" and runs["bad"]["new_watermark"] is None
    assert runs["bad"]["records_fetched"] == 2
    assert "BatchKeyConflict" in runs["bad"]["error_message"]
    assert current_watermark(store, DEFAULT_SOURCE) == datetime(2024, 2, 1, 10)
    assert set(stored(store)) == {"TXN-0001"}

    # Days written but not committed stay invisible.
    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr("ledgerline.sources.store.subfolders", lost)
    with pytest.raises(OSError, match="lost"):
        load(spark, store, contract, [txn(1, "01", status="failed"), txn(2, "01")])
    monkeypatch.undo()
    assert stored(store) == {"TXN-0001": ("completed", False, "2024-02-01")}

    kept = load(spark, store, contract, clash, on_conflict="latest")
    assert kept["status"] == "success"
    assert stored(store)["TXN-0002"][2] == "2024-02-21"


def test_empty_batch_after_reset(spark, store, contract):
    load(spark, store, contract, [txn(1, "01")])
    report = load(spark, store, contract, [], summary=True, reset=True)
    assert store.runs.current("run_id").count() == 1
    assert (report["records_fetched"], report["new_watermark"]) == (0, None)
    assert store.bronze.read().count() == 0 and store.summary.read().count() == 0


def test_day_labels_are_bounded(spark):
    days = ["2024-02-29", "0001-01-01", "9999-12-31"]
    frame = spark.createDataFrame([(d,) for d in days], "d string").selectExpr(
        "cast(d AS timestamp_ntz) AS transaction_date"
    )
    assert [r[0] for r in frame.coalesce(1).select(event_day()).collect()] == [
        "2024-02-29",
        "undated",
        "undated",
    ]


def test_stream_takes_each_file_once(spark, store, contract, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    deliveries = [
        [txn(1, "01"), txn(2, "02"), txn(3, "02", status="done")],
        [txn(2, "02", status="failed"), txn(4, "04"), {**txn(1, "01"), "transaction_id": "TXN-0000"}],
        ["not json", txn(5, "01")],
    ]

    def deliver(n):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in deliveries[n]]
        part = landing / f"part-{n}.json"
        part.write_text("\n".join(lines) + "\n")
        os.utime(part, (1_700_000_000 + n, 1_700_000_000 + n))

    def drain():
        query = start_ingest_stream(
            store, str(landing), str(tmp_path / "ckpt"), contract, max_files_per_trigger=1
        )
        query.awaitTermination()

    deliver(0)
    deliver(1)
    drain()
    deliver(2)
    drain()
    assert stored(store) == {
        "TXN-0001": ("completed", True, "2024-02-01"),
        "TXN-0000": ("completed", False, "2024-02-01"),
        "TXN-0002": ("failed", False, "2024-02-02"),
        "TXN-0004": ("completed", False, "2024-02-04"),
        "TXN-0005": ("completed", False, "2024-02-01"),
    }
    assert store.runs.current("run_id").count() == 3
    reasons = {r["error_reason"] for r in store.quarantine.read().collect()}
    assert reasons == {"payload: not_an_object", "status: invalid_status (got 'done')"}


def test_run_ids_sort_by_time():
    start = datetime(2024, 1, 2, 3, 4, 5)
    one, two = new_run_id(start), new_run_id(start + timedelta(seconds=1))
    assert one.startswith("20240102T030405-") and len(one) == 22 and one < two


def test_arguments_are_checked(spark, store, contract):
    with pytest.raises(ValueError, match="mode"):
        load(spark, store, contract, [GOOD], mode="partial")
    with pytest.raises(ValueError, match="reset"):
        load(spark, store, contract, [GOOD], mode="incremental", reset=True)
    with pytest.raises(ValueError, match="on_conflict"):
        _batch(spark.range(1), "id", "ignore")


def test_late_records_are_counted_but_not_checked(spark, contract):
    """What the window leaves out is parsed for its date alone; what is no object is taken."""
    texts = [txn(1, "01"), txn(2, "05", amount="abc"), txn(3, "01", amount="abc"), "[1]", {"amount": 1}]
    checked = check_payloads(
        payload_frame(spark, texts), contract,
        lambda date, is_object: F.coalesce((date >= "2024-02-03") | ~is_object, F.lit(False)),
    )
    rows = checked.select("transaction_id", "payload", F.size("violations").alias("n"), "is_object").collect()
    assert [(r[0], r[1] is not None, r[2], r[3]) for r in rows] == [
        (None, False, 0, True),
        ("TXN-0002", True, 1, True),
        (None, False, 0, True),
        (None, True, 1, False),
        (None, False, 0, True),
    ]
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(concat([") == 1 and "Filter" not in plan
