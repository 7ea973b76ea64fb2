"""Usual windows and bounds against plain quartiles of the rows."""

from __future__ import annotations

import math
import random
from datetime import date, timedelta

import pytest
from helpers import payload_frame, record
from pyspark.sql import functions as F

from ledgerline.operators import outliers, rollup
from ledgerline.operators.routing import check_payloads

FIRST = date(2024, 1, 1)


def covering(values, share):
    known = sorted(values)
    return known[max(0, math.ceil(len(known) * share) - 1)]


def counted(spark, days):
    return spark.createDataFrame(days, "day date, n bigint")


@pytest.mark.parametrize("seed", range(3))
def test_window_of_days(spark, seed):
    rng = random.Random(seed)
    days = [FIRST + timedelta(days=int(rng.gauss(40, 12))) for _ in range(200)]
    days += [date(2031, 5, 6)] * 20 + [date(1999, 1, 1)] * 9
    # Counts of two loads, in which days repeat.
    counts = [(d, 1) for d in days[:90]] + [(d, days[90:].count(d)) for d in set(days[90:])]
    q1, q3 = covering(days, 0.25), covering(days, 0.75)
    reach = timedelta(days=math.ceil(1.5 * max(1, (q3 - q1).days)))
    got = outliers.usual_days(counted(spark, counts)).first()
    assert tuple(got) == (q1 - reach, q3 + reach)


def test_a_single_day_and_none(spark, contract):
    one = outliers.usual_days(counted(spark, [(FIRST, 5)])).first()
    assert tuple(one) == (FIRST - timedelta(days=2), FIRST + timedelta(days=2))
    none = counted(spark, [])
    assert tuple(outliers.usual_days(none).first()) == (None, None)
    assert outliers.learned_contract(contract, none) == contract


def test_only_strict_dates_count(spark):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T23:59:59Z", "2024-02-30T00:00:00Z", "x", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "transaction_date string")
    assert [tuple(r) for r in outliers.day_counts(frame).collect()] == [(FIRST, 2)]


def test_checks_take_the_learned_window(spark, contract):
    """Records of another year pass, and those far from them are quarantined."""
    dates = [f"2031-03-{d:02d}T10:00:00Z" for d in range(1, 29)] + ["2024-02-10T09:15:30Z"]
    given = payload_frame(spark, [record(transaction_date=d) for d in dates])
    raw = given.select(F.get_json_object("payload", "$.transaction_date").alias("transaction_date"))
    learned = outliers.learned_contract(contract, outliers.day_counts(raw))
    found = check_payloads(given, learned).select("transaction_date", "violations").collect()
    bad = {r["transaction_date"]: r["violations"] for r in found if r["violations"]}
    text = "transaction_date: outside_expected_window_usual (got '2024-02-10T09:15:30Z')"
    assert bad == {"2024-02-10T09:15:30Z": [text]}


def test_amounts(spark):
    rng = random.Random(5)
    rows = [(n % 5, g, rng.lognormvariate(mu, 0.3)) for g, mu in (("a", 2), (None, 6)) for n in range(300)]
    rows += [(0, "a", 900.0), (1, "a", 0.01), (2, "a", 0.0), (3, "a", -4.0), (4, "a", None), (4, None, 7.4)]
    rows += [(0, "same", 3.0)] * 9 + [(0, "same", 4.0)]
    frame = spark.createDataFrame(rows, "day int, g string, x double")
    usual = outliers.usual_amounts(rollup.daily_sketch(frame, "day", F.col("x"), "g"), "g")
    got = outliers.unusual_amounts(frame, usual, F.col("x"), ["g"]).collect()

    def step(x):
        return math.ceil(math.log(x) / math.log(1.01 / 0.99)) if x > 0 else -math.inf

    want = []
    for g in ("a", None, "same"):
        steps = [step(x) for _, h, x in rows if h == g and x is not None]
        q1, q3 = covering(steps, 0.25), covering(steps, 0.75)
        reach = math.ceil(1.5 * max(1, q3 - q1))
        want += [
            (d, h, x)
            for d, h, x in rows
            if h == g and x is not None and not q1 - reach <= step(x) <= q3 + reach
        ]
    assert sorted(map(repr, want)) == sorted(repr((r["day"], r["g"], r["x"])) for r in got)
    assert {(r["g"], r["x"]) for r in got} >= {("a", 900.0), ("a", 0.01), ("a", 0.0), ("a", -4.0), ("same", 4.0)}
    assert (None, 7.4) in {(r["g"], r["x"]) for r in got}
    assert all(r["low"] < r["high"] for r in got)


def test_no_amounts(spark):
    frame = spark.createDataFrame([], "day int, g string, x double")
    usual = outliers.usual_amounts(rollup.daily_sketch(frame, "day", F.col("x"), "g"), "g")
    assert outliers.unusual_amounts(frame, usual, F.col("x"), ["g"]).count() == 0
