from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

from helpers import bronze_frame, bronze_row

from ledgerline.operators.checksum import SUMMARY_CONTENT, is_idempotent
from ledgerline.operators.dedup import flag_duplicates
from ledgerline.plans.staging import stg_transactions
from ledgerline.plans.summary import daily_account_summary, daily_account_summary_by_joins
from ledgerline.plans.warehouse import AS_OF

COLUMNS = ["account", "day", "amount", "type", "status", "merchant", "category", "currency", "key"]
# Two days of one traveller, a shop that only refunds, and an account with nothing completed.
SPECS = [
    ("ACC-0310", 3, "64.90", "debit", "completed", "Night Train", "travel", "CHF", "a"),
    ("ACC-0310", 3, "12.35", "debit", "completed", "Station Cafe", "food_and_beverage", "EUR", "b"),
    ("ACC-0310", 3, "12.35", "debit", "completed", "Station Cafe", "food_and_beverage", "EUR", "b"),
    ("ACC-0310", 3, "7.05", "credit", "completed", "Station Cafe", "travel", "CHF", "c"),
    ("ACC-0310", 4, "30.00", "debit", "completed", "Museum", "entertainment", "EUR", "d"),
    ("ACC-0310", 4, "30.00", "debit", "completed", "Market", "groceries", "EUR", "e"),
    ("ACC-0777", 3, "5.50", "credit", "completed", "Market", "retail", "GBP", "f"),
    ("ACC-0900", 3, "81.00", "debit", "pending", "Museum", "travel", "EUR", "g"),
]


def staging(spark, specs):
    rows = [
        bronze_row(
            f"TXN-{n:05d}",
            account_id=s["account"],
            transaction_date=datetime(2024, 1, s["day"], 10),
            amount=Decimal(s["amount"]),
            transaction_type=s["type"],
            status=s["status"],
            merchant_name=s["merchant"],
            merchant_category=s["category"],
            currency=s["currency"],
            natural_key_hash=s["key"],
        )
        for n, s in enumerate((dict(zip(COLUMNS, spec, strict=True)) for spec in specs), 1)
    ]
    return stg_transactions(flag_duplicates(bronze_frame(spark, rows)))


def test_small_summary(spark):
    stg = staging(spark, SPECS)
    got = sorted(
        tuple(r) for r in daily_account_summary(stg, AS_OF).collect()
    )
    d = Decimal
    assert got == [
        ("ACC-0310", date(2024, 1, 3), d("77.25"), d("7.05"), d("-70.20"), 3, 2, "travel", "CHF,EUR", AS_OF),
        ("ACC-0310", date(2024, 1, 4), d("60.00"), d("0.00"), d("-60.00"), 2, 2, "entertainment", "EUR", AS_OF),
        ("ACC-0777", date(2024, 1, 3), d("0.00"), d("5.50"), d("5.50"), 1, 1, "retail", "GBP", AS_OF),
    ]
    assert is_idempotent(lambda: daily_account_summary(stg), SUMMARY_CONTENT)
    assert daily_account_summary(stg).where("updated_at IS NULL").count() == 0


def test_empty_input(spark):
    stg = staging(spark, SPECS[:1]).where("false")
    assert daily_account_summary(stg).count() == 0


def test_both_forms_match_brute_force(spark):
    """One account-day holds a third of the rows; categories often tie."""
    rng = random.Random(11)
    specs = []
    for n in range(600):
        account = "ACC-0001" if n % 3 == 0 else f"ACC-{rng.randrange(2, 9):04d}"
        day = 5 if n % 3 == 0 else rng.randrange(1, 4)
        specs.append(
            (
                account, day, f"{rng.randrange(1, 4)}.00", rng.choice(["debit", "credit"]),
                rng.choice(["completed", "completed", "pending"]), f"m{rng.randrange(30)}",
                rng.choice(["travel", "retail", "health"]), rng.choice(["USD", "EUR", "CAD"]), str(n),
            )
        )
    groups: dict[tuple, list] = {}
    for s in (dict(zip(COLUMNS, spec, strict=True)) for spec in specs):
        if s["status"] == "completed":
            groups.setdefault((s["account"], s["day"]), []).append(s)
    expected = []
    for (account, day), rows in groups.items():
        total = {"debit": Decimal(0), "credit": Decimal(0)}
        spend: dict[str, Decimal] = {}
        for r in rows:
            total[r["type"]] += Decimal(r["amount"])
            spend[r["category"]] = spend.get(r["category"], Decimal(0)) + Decimal(r["amount"])
        top = min(spend, key=lambda c: (-spend[c], c))
        expected.append(
            (
                account, date(2024, 1, day), total["debit"], total["credit"],
                total["credit"] - total["debit"], len(rows), len({r["merchant"] for r in rows}),
                top, ",".join(sorted({r["currency"] for r in rows})),
            )
        )
    stg = staging(spark, specs)
    for build in (daily_account_summary, daily_account_summary_by_joins):
        got = [tuple(r) for r in build(stg, AS_OF).select(*SUMMARY_CONTENT).collect()]
        assert sorted(got) == sorted(expected)
