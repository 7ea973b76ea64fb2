from __future__ import annotations

import random
from datetime import datetime

import pytest
from helpers import bronze_frame, bronze_row, payload_frame, record
from pyspark.sql import functions as F

from ledgerline.ingest import run_ingest
from ledgerline.operators.dedup import (
    duplicate_groups,
    duplicate_members,
    flag_duplicates,
    flagged_count,
    repeated_hashes,
)
from ledgerline.operators.upsert import (
    BatchKeyConflict,
    assert_unique,
    latest_per_key,
    upsert,
)
from ledgerline.session import materialize
from ledgerline.sources.store import DailyTable, Store


def on(day: int) -> dict:
    return {"transaction_date": datetime(2024, 1, day, 8)}


ROWS = [
    bronze_row("TXN-0003", natural_key_hash="nk1", **on(15)),
    bronze_row("TXN-0001", natural_key_hash="nk1", **on(15)),
    bronze_row("TXN-0002", natural_key_hash="nk1", **on(16)),
    bronze_row("TXN-0009", natural_key_hash="nk2", **on(15)),
]


def flags(frame):
    return {
        r["transaction_id"]: (r["is_duplicate"], r["duplicate_of_transaction_id"])
        for r in frame.collect()
    }


def test_earliest_then_lowest_id_survives(spark):
    flagged = flag_duplicates(bronze_frame(spark, ROWS))
    assert flags(flagged) == {
        "TXN-0001": (False, None),
        "TXN-0002": (True, "TXN-0001"),
        "TXN-0003": (True, "TXN-0001"),
        "TXN-0009": (False, None),
    }
    assert flagged_count(flagged).first()[0] == 2
    assert flags(flag_duplicates(flagged)) == flags(flagged)
    assert flagged.columns == bronze_frame(spark, ROWS).columns
    members = {r["transaction_id"] for r in duplicate_members(flagged).collect()}
    assert members == {"TXN-0001", "TXN-0002", "TXN-0003"}


@pytest.mark.parametrize(("hot_group_rows", "hot_groups"), [(2, 100_000), (2, 3), (20, 1), (10_000, 1)])
def test_flags_match_brute_force_with_a_hot_group(spark, hot_group_rows, hot_groups):
    """A third of all rows share one key; both bounds are exceeded, and neither matters."""
    rng = random.Random(5)
    rows = []
    for n in range(900):
        key = "hot" if n % 3 == 0 else f"k{rng.randrange(200)}"
        rows.append((f"T{rng.randrange(10**9):09d}-{n}", rng.randrange(5), key))
    frame = spark.createDataFrame(rows, "transaction_id string, transaction_date int, k string")
    got = flags(
        flag_duplicates(
            frame.repartition(7), key="k", hot_group_rows=hot_group_rows, hot_groups=hot_groups
        )
    )
    survivors: dict[str, tuple[int, str]] = {}
    for txn, date, key in rows:
        survivors[key] = min(survivors.get(key, (99, "")), (date, txn))
    expected = {
        txn: (False, None) if survivors[key][1] == txn else (True, survivors[key][1])
        for txn, _, key in rows
    }
    assert got == expected


@pytest.mark.parametrize("few_groups", [0, 10_000])
def test_groups_written_beforehand_give_the_same_flags(spark, few_groups):
    rng = random.Random(9)
    rows = [(f"T{n}", rng.randrange(5), rng.choice([None, "hot", f"k{rng.randrange(200)}"])) for n in range(600)]
    frame = materialize(spark.createDataFrame(rows, "transaction_id string, transaction_date int, k string"), "rows")
    groups = materialize(duplicate_groups(frame, "k"), "groups")
    flagged = flag_duplicates(frame, "k", groups=groups, few_groups=few_groups)
    assert flags(flagged) == flags(flag_duplicates(frame, "k"))
    plan = flagged._jdf.queryExecution().sparkPlan().toString()
    # Few groups meet the rows where these lie: no join needs a shuffle.
    assert ("SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan) or not few_groups
    assert flagged.where("is_duplicate").count() > 200


def test_flagging_stored_days_shuffles_rows_once(spark, store, contract, monkeypatch):
    """Rows are dealt to the files of their day; the survivors come to them."""
    frame = payload_frame(spark, [record(transaction_id=f"TXN-{n}") for n in range(4)])
    seen = []
    stage = DailyTable.stage

    def spied(self, rows, *args, **more):
        if self.name == "bronze":
            seen.append(rows._jdf.queryExecution().sparkPlan().toString())
        return stage(self, rows, *args, **more)

    monkeypatch.setattr(DailyTable, "stage", spied)
    run_ingest(frame, store, contract, run_id="r")
    assert "BroadcastHashJoin" in seen[0]
    assert "SortMergeJoin" not in seen[0] and "partial_min" not in seen[0]
    got = {r[0]: r[1] for r in store.bronze.read().select("transaction_id", "duplicate_of_transaction_id").collect()}
    assert got == {"TXN-0": None, "TXN-1": "TXN-0", "TXN-2": "TXN-0", "TXN-3": "TXN-0"}


@pytest.mark.parametrize("few_groups", [0, 10_000])
def test_only_rows_of_repeated_hashes_are_grouped(spark, few_groups):
    rng = random.Random(3)
    rows = [(f"T{n}", rng.randrange(5), rng.choice([None, "hot", f"k{rng.randrange(400)}"])) for n in range(600)]
    frame = materialize(spark.createDataFrame(rows, "transaction_id string, transaction_date int, k string"), "rows")
    once = frame.groupBy("k").count().where("count = 1").select(F.xxhash64("k"))
    assert once.count() > 50
    # As if two keys shared a hash by chance: hashes of single rows are listed too.
    repeated = materialize(repeated_hashes(frame, "k").union(once), "repeated")
    groups = duplicate_groups(frame, "k", repeated=repeated, few_groups=few_groups)
    assert sorted(groups.collect(), key=str) == sorted(duplicate_groups(frame, "k").collect(), key=str)
    assert ("LeftSemi" in groups._jdf.queryExecution().sparkPlan().toString()) == (few_groups > 0)


def test_many_groups_are_looked_up_without_a_sort(spark):
    """Rows that must be shuffled to their groups are not sorted there."""
    rows = [(f"T{n}", n % 5, f"k{n % 50}") for n in range(200)]
    frame = materialize(spark.createDataFrame(rows, "transaction_id string, transaction_date int, k string"), "rows")
    groups = materialize(duplicate_groups(frame, "k"), "groups")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")  # as if every table were large
    try:
        flagged = flag_duplicates(frame, "k", groups=groups, few_groups=0)
        plan = flagged._jdf.queryExecution().sparkPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        assert flags(flagged) == flags(flag_duplicates(frame, "k"))
    finally:
        spark.conf.set(threshold, held)


def test_runs_group_only_rows_of_repeated_hashes(spark, store, contract, monkeypatch):
    """Of a row that is alone, a number is shuffled and not its key, time and id."""
    staged, plans = Store.staged, []

    def spied(self, rows, *by):
        if "_group_size" in rows.columns:
            plans.append(rows._jdf.queryExecution().sparkPlan().toString())
        return staged(self, rows, *by)

    monkeypatch.setattr(Store, "staged", spied)
    frame = payload_frame(spark, [record(transaction_id=f"TXN-{n}") for n in range(4)])
    run_ingest(frame, store, contract, run_id="r")
    assert len(plans) == 1 and "LeftSemi" in plans[0]
    assert store.bronze.read().where("is_duplicate").count() == 3


def test_upsert_replaces_and_inserts(spark):
    old = bronze_frame(spark, [bronze_row("A", status="pending"), bronze_row("B")])
    new = bronze_frame(spark, [bronze_row("A", status="completed"), bronze_row("C")])
    merged = upsert(old, new, "transaction_id")
    got = {r["transaction_id"]: r["status"] for r in merged.collect()}
    assert got == {"A": "completed", "B": "completed", "C": "completed"}
    again = upsert(merged, new, "transaction_id")
    assert sorted(again.collect()) == sorted(merged.collect())
    assert sorted(upsert(old, new.where("false"), "transaction_id").collect()) == sorted(
        old.collect()
    )


def test_batch_conflicts(spark):
    batch = spark.createDataFrame(
        [("A", 1, "x"), ("A", 2, "y"), ("B", 1, "z")], "id string, seq int, v string"
    )
    with pytest.raises(BatchKeyConflict, match="id = 'A'"):
        assert_unique(batch, "id")
    kept = latest_per_key(batch, "id", ["seq"])
    assert_unique(kept, "id")
    assert sorted(map(tuple, kept.collect())) == [("A", 2, "y"), ("B", 1, "z")]
