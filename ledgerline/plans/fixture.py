"""Payment records derived from the ``events`` table, with defects of every kind.

The column expressions are plain SQL that Spark and DuckDB read alike, so the
comparison queries start from the same records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ``d`` picks the defect of a record, ``pfx`` marks the second copy of a record.
DEFECT = "event_id % 97"
# The first of two loads ends here, the second starts at the watermark less the lookback.
FIRST_LOAD_END = "2024-01-21"
SECOND_COPY = "event_id % 70 = 0"

TXN_COLUMNS = {
    "transaction_id": "CASE WHEN d = 9 THEN 'TXN' ELSE 'TXN-' END || pfx || cast(event_id AS string)",
    "account_id": "CASE WHEN d = 4 THEN NULL ELSE 'ACC-' || lpad(cast(user_id % 10000 AS string), 4, '0') END",
    "transaction_date": """CASE WHEN d = 1 THEN substr(cast(ts AS string), 1, 19)
        WHEN d = 2 THEN '2024-11-31T14:22:00Z'
        WHEN d = 6 THEN '2029-01-15T08:23:11Z'
        ELSE replace(substr(cast(ts AS string), 1, 19), ' ', 'T') || 'Z' END""",
    "amount": """CASE WHEN d = 1 THEN '-127.5' WHEN d = 3 THEN '0.0' WHEN d = 5 THEN '10.123'
        WHEN d = 7 THEN 'abc' ELSE cast(cast(value AS decimal(18,2)) AS string) END""",
    "currency": """CASE WHEN d = 9 THEN 'usd'
        ELSE split_part('USD,EUR,GBP,CHF,JPY,AUD,CAD', ',', cast(event_id % 7 + 1 AS int)) END""",
    "transaction_type": "CASE WHEN d = 3 THEN 'Credit' WHEN event_id % 3 = 0 THEN 'credit' ELSE 'debit' END",
    "merchant_name": "CASE WHEN d = 1 THEN '   ' ELSE 'Merchant ' || cast(event_id * 7 % 40 AS string) END",
    "merchant_category": """CASE WHEN d = 2 THEN 'fast_food' WHEN d = 3 THEN 'Finance'
        ELSE split_part('e-commerce,travel,food_and_beverage,groceries,electronics,retail,entertainment,health,transportation,home_and_garden,payroll,transfer', ',', cast(event_id % 12 + 1 AS int)) END""",
    "status": """CASE WHEN d = 1 THEN 'Completed' WHEN event_type = 'view' THEN 'pending'
        WHEN event_type = 'error' THEN 'failed'
        WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'reversed' ELSE 'completed' END""",
    "country_code": """CASE WHEN d = 2 THEN 'UK' WHEN d = 3 THEN 'EN' WHEN d = 8 THEN '1S'
        ELSE split_part('US,GB,DE,JP,AU,FR,NL,ES,CA', ',', cast(event_id % 9 + 1 AS int)) END""",
}


def _text_member(name: str) -> str:
    return f"""CASE WHEN {name} IS NULL THEN '' ELSE ', "{name}": "' || {name} || '"' END"""


# JSON text of a record; ``k`` picks a defect that only JSON can have.
PAYLOAD = f"""CASE
    WHEN k = 10 THEN '["' || transaction_id || '"]'
    WHEN k = 11 THEN '{{"transaction_id": "' || transaction_id
    ELSE '{{"id": ' || cast(event_id AS string) || ', "transaction_id": "' || transaction_id || '"'
      || CASE WHEN k = 5 THEN ', "account_id": 1234' WHEN k = 13 THEN ', "account_id": "ACC-101"' ELSE {_text_member("account_id")} END
      || {_text_member("transaction_date")}
      || CASE WHEN k = 3 AND amount <> 'abc' THEN ', "amount": ' || amount
              WHEN k = 15 THEN ', "amount": 1' WHEN k = 16 THEN ', "amount": 1.0'
              WHEN k = 17 THEN ', "amount": -1.0'
              WHEN k = 4 THEN ', "amount": true' ELSE {_text_member("amount")} END
      || CASE WHEN k = 9 THEN ', "currency": "O''X"' ELSE {_text_member("currency")} END
      || {_text_member("transaction_type")}
      || CASE WHEN k = 6 THEN ', "merchant_name": null' WHEN k = 7 THEN ', "merchant_name": []'
              WHEN k = 18 THEN ', "merchant_name": {{"z": ["x", 1, null, 2.50], "a": {{"b": true}}}}'
              WHEN k = 12 THEN ', "merchant_name": 77' ELSE {_text_member("merchant_name")} END
      || {_text_member("merchant_category")}
      || {_text_member("status")}
      || CASE WHEN k = 14 THEN ', "country_code": "us"' ELSE {_text_member("country_code")} END
      || CASE WHEN k = 1 THEN ', "bogus": 1' WHEN k = 8 THEN ', "zeta": [1], "alpha": "x"'
              WHEN k = 2 THEN ', "updated_at": "2024-02-01"' ELSE '' END
      || '}}' END"""


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _txn_with_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One scan: a record that has a second copy is exploded into two rows.
    copies = F.expr(f"CASE WHEN {SECOND_COPY} THEN array('', 'D') ELSE array('') END")
    events = load(spark, sf_dir, "events").select(
        "event_id",
        F.expr(DEFECT).alias("d"),
        F.explode(copies).alias("pfx"),
        "ts",
        "user_id",
        "event_type",
        "value",
    )
    columns = [F.expr(sql).alias(name) for name, sql in TXN_COLUMNS.items()]
    return events.select("event_id", *columns)


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten string columns: a record before any check."""
    return _txn_with_event(spark, sf_dir).select(*TXN_COLUMNS)


# Which of two deliveries brings a payload: what is no JSON object comes second.
DELIVERY = f"CASE WHEN transaction_date < '{FIRST_LOAD_END}' AND k NOT IN (10, 11) THEN 1 ELSE 2 END"


def _payload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _txn_with_event(spark, sf_dir).withColumn("k", F.expr("event_id % 89"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as JSON texts, with type and key defects on top."""
    return _payload_records(spark, sf_dir).select(F.expr(PAYLOAD).alias("payload"))


def payload_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON texts with the delivery that brings each."""
    records = _payload_records(spark, sf_dir)
    return records.select(F.expr(PAYLOAD).alias("payload"), F.expr(DELIVERY).alias("delivery"))
