"""Small hand-made records and rows."""

from __future__ import annotations

import json
from datetime import datetime
from decimal import Decimal
from typing import Any

from ledgerline import schemas

GOOD: dict[str, Any] = {
    "transaction_id": "TXN-7001",
    "account_id": "ACC-4242",
    "transaction_date": "2024-02-10T09:15:30Z",
    "amount": "18.40",
    "currency": "CHF",
    "transaction_type": "debit",
    "merchant_name": "Corner Shop",
    "merchant_category": "groceries",
    "status": "completed",
    "country_code": "DE",
}


def record(**changes: Any) -> dict[str, Any]:
    return {**GOOD, **changes}


def without(*fields: str) -> dict[str, Any]:
    return {k: v for k, v in GOOD.items() if k not in fields}


def payload_frame(spark, records: list[Any]):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def bronze_row(txn_id: str, **changes: Any) -> tuple:
    row = {
        "transaction_id": txn_id,
        "account_id": "ACC-4242",
        "transaction_date": datetime(2024, 2, 10, 9),
        "transaction_date_raw": "2024-02-10T09:00:00Z",
        "amount": Decimal("10.00"),
        "currency": "CHF",
        "transaction_type": "debit",
        "merchant_name": "Corner Shop",
        "merchant_category": "groceries",
        "status": "completed",
        "country_code": "DE",
        "natural_key_hash": txn_id,
        "is_duplicate": False,
        "duplicate_of_transaction_id": None,
        "source_system": "test",
        "source_payload": "{}",
        "ingestion_run_id": "r",
        "ingestion_timestamp": datetime(2024, 4, 1),
    }
    row.update(changes)
    return tuple(row[n] for n in schemas.BRONZE.fieldNames())


def bronze_frame(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, schemas.BRONZE)
