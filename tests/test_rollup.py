"""Ordered pages, counts and percentiles that roll up, and rates with gaps."""

from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import rollup
from ledgerline.operators.monitoring import (
    days_without_rate,
    lag_sketch,
    lookback_from_lag,
    lookback_from_sketch,
    rates_as_of,
    reporting_amounts_as_of,
)
from ledgerline.operators.ordered import ordered_pages, with_positions
from ledgerline.sources.landing import iter_pages


def test_pages_are_those_of_a_walk(spark):
    rng = random.Random(1)
    rows = [(f"2024-01-{rng.randint(1, 9):02d}", f"T{n:03d}", n) for n in range(95)]
    frame = spark.createDataFrame(rows, "transaction_date string, transaction_id string, n int").repartition(4)
    pages = ordered_pages(frame, 10, ["transaction_date", "transaction_id"], parts=5)
    got = {}
    for r in pages.collect():
        got.setdefault(r["page"], []).append((r["position"], r["n"]))
    walk = [[r["n"] for r in page] for page in iter_pages(frame, 10)]
    assert [[n for _, n in sorted(got[p])] for p in sorted(got)] == walk
    assert sorted(i for page in got.values() for i, _ in page) == list(range(95))


def test_positions_of_ties_nulls_and_nothing(spark):
    rows = [("b", 1), (None, 2), ("a", 3), ("a", 3), ("a", 4), (None, None)]
    frame = spark.createDataFrame(rows, "k string, v int")
    got = sorted((r["position"], r["k"]) for r in with_positions(frame, ["k"], parts=3).collect())
    assert [k for _, k in got] == ["a", "a", "a", "b", None, None] and [p for p, _ in got] == list(range(6))
    assert with_positions(frame.where("v > 9"), ["k"]).count() == 0


def test_distinct_counts_roll_up(spark):
    rng = random.Random(2)
    rows = [(date(2024, rng.randint(1, 3), rng.randint(1, 28)), rng.choice("xy"), rng.choice([None, *"abcdefgh"])) for _ in range(400)]
    frame = spark.createDataFrame(rows, "day date, g string, v string")
    early = frame.where("day < '2024-02-01'")
    names = rollup.dictionary(early.select("v"))
    wider = rollup.dictionary(frame.select("v"), names)
    ids = {r["value"]: r["id"] for r in wider.collect()}
    assert sorted(ids.values()) == list(range(len(ids)))
    assert {r["value"]: r["id"] for r in names.collect()}.items() <= ids.items()
    # Bitmaps of early days were made with the smaller dictionary and still hold.
    days = rollup.daily_bitmaps(early, names, "day", "v", "g").unionByName(
        rollup.daily_bitmaps(frame.where("day >= '2024-02-01'"), wider, "day", "v", "g")
    )
    got = {(r["period"], r["g"]): r["distinct_values"] for r in rollup.distinct_in(days, F.quarter("day"), "g").collect()}
    assert got == {(1, g): len({v for _, h, v in rows if h == g and v}) for g in "xy"}
    by_month = {(r["period"], r["g"]): r["distinct_values"] for r in rollup.distinct_in(days, F.month("day"), "g").collect()}
    assert by_month == {(m, g): len({v for d, h, v in rows if (d.month, h) == (m, g) and v}) for m in (1, 2, 3) for g in "xy"}


def test_bitmaps_of_many_buckets(spark):
    names = spark.range(100_000).select(F.col("id").cast("string").alias("value"), "id")
    rows = names.select(F.lit("d").alias("day"), F.col("value").alias("v"))
    days = rollup.daily_bitmaps(rows, names, "day", "v")
    assert days.count() == 5  # id 0 has a bucket to itself
    assert rollup.distinct_in(days, F.col("day")).first()["distinct_values"] == 100_000


@pytest.mark.parametrize("share", [0.01, 0.5, 0.9, 0.99, 1.0])
def test_sketched_percentiles_are_near_the_exact_ones(spark, share):
    rng = random.Random(3)
    values = [rng.lognormvariate(6, 3) for _ in range(3000)] + [0.0, -5.0, None]
    frame = spark.createDataFrame([(n % 9, v) for n, v in enumerate(values)], "day int, x double")
    by_day = rollup.daily_sketch(frame, "day", F.col("x"))
    got = rollup.quantile_of(by_day, share).first()["quantile"]
    known = sorted(max(v, 0) for v in values if v is not None)
    exact = known[max(0, -(-int(share * len(known) * 1000) // 1000) - 1)]
    near = [known[max(0, known.index(exact) - 1)], known[min(len(known) - 1, known.index(exact) + 1)]]
    assert (1 - rollup.ERROR) * min(near) <= got <= (1 + rollup.ERROR) * max(near)
    # One more day is one more merge.
    merged = rollup.merged_sketch(by_day.where("day < 5")).withColumn("day", F.lit(0))
    again = merged.select("day", "step", "n").unionAll(by_day.where("day >= 5"))
    assert rollup.quantile_of(again, share).first()["quantile"] == got


def test_lookback_from_sketches(spark):
    rows = [(datetime(2024, 1, 1), datetime(2024, 1, 1 + n % 5, n % 24, 7)) for n in range(300)]
    frame = spark.createDataFrame(rows, "transaction_date timestamp_ntz, ingestion_timestamp timestamp_ntz")
    exact = lookback_from_lag(frame).first()["lookback_days"]
    assert lookback_from_sketch(lag_sketch(frame)).first()["lookback_days"] == exact == 5


def test_rates_are_carried_on(spark):
    rates = spark.createDataFrame(
        [("EUR", date(2024, 1, 2), Decimal("1.5")), ("EUR", date(2024, 1, 5), Decimal("2")), ("USD", date(2024, 1, 1), Decimal("1"))],
        "currency string, transaction_date date, rate decimal(10,4)",
    )
    days = [("EUR", d) for d in (1, 2, 4, 5, 9)] + [("USD", 3), ("GBP", 3), (None, 3), ("USD", 3)]
    rows = [(f"A{n}", date(2024, 1, d), c, "credit", Decimal("2.00")) for n, (c, d) in enumerate(days)]
    frame = spark.createDataFrame(rows, "account_id string, transaction_date date, currency string, transaction_type string, amount decimal(18,2)")
    got = {(r[0], r[1].day): (r[2] and float(r[2]), r[3] and r[3].day) for r in rates_as_of(frame, rates).collect()}
    assert got == {
        ("EUR", 1): (None, None), ("EUR", 2): (1.5, 2), ("EUR", 4): (1.5, 2), ("EUR", 5): (2, 5), ("EUR", 9): (2, 5),
        ("USD", 3): (1, 1), ("GBP", 3): (None, None), (None, 3): (None, None),
    }
    out = {r["account_id"]: (r[2] and float(r[2]), r[3]) for r in reporting_amounts_as_of(frame, rates).collect()}
    assert out["A0"] == (None, 1) and out["A2"] == (3.0, 0) and out["A4"] == (4.0, 0) and out["A6"] == (None, 1)
    assert {(r[0], r[1].day) for r in days_without_rate(frame, rates).collect()} == {("EUR", 1), ("GBP", 3), (None, 3)}
