from __future__ import annotations

import random
from datetime import datetime

from conftest import TESTDATA
from pyspark.sql import functions as F

from ledgerline.functions.times import utc_literal
from ledgerline.operators.watermark import advance_watermark, late_split
from ledgerline.plans.fixture import txn
from ledgerline.sources.landing import (
    incremental_scan,
    iter_pages,
    keyset_page,
    offset_page,
    requested_from,
)


def records(spark, n):
    rng = random.Random(n)
    rows = [(f"2024-01-0{rng.randrange(1, 4)}", f"TXN-{k:04d}") for k in range(n)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "transaction_date string, transaction_id string")
    return frame, sorted(rows)


def test_pages_cover_every_record_once_in_order(spark):
    frame, expected = records(spark, 25)
    pages = [list(map(tuple, p)) for p in iter_pages(frame, 10)]
    assert [len(p) for p in pages] == [10, 10, 5]
    assert sum(pages, []) == expected


def test_a_full_last_page_is_followed_by_an_empty_one(spark):
    frame, expected = records(spark, 20)
    pages = list(iter_pages(frame, 10))
    assert [len(p) for p in pages] == [10, 10, 0]
    assert [len(p) for p in iter_pages(frame.where("false"), 10)] == [0]


def test_keyset_and_offset_pages_agree(spark):
    frame, expected = records(spark, 30)
    by_offset = list(map(tuple, offset_page(frame, 7, 14).collect()))
    by_key = list(map(tuple, keyset_page(frame, 7, after=expected[13]).collect()))
    assert by_offset == by_key == expected[14:21]


def test_since_is_inclusive_and_textual(spark):
    texts = [
        ("2024-02-08T10:00:00Z",),
        ("2024-02-08T09:59:59Z",),
        ("2024-11-31T14:22:00Z",),
        ("15/01/2024",),
        (None,),
        ("zzz",),
    ]
    frame = spark.createDataFrame(texts, "transaction_date string")
    mark = utc_literal(datetime(2024, 2, 10, 10, 0, 0, 500))
    got = {r[0] for r in incremental_scan(frame, mark, 2).collect()}
    assert got == {"2024-02-08T10:00:00Z", "2024-11-31T14:22:00Z", "zzz"}
    split = late_split(frame, mark, 2).groupBy("arrival").count()
    assert dict(map(tuple, split.collect())) == {"accepted": 3, "too_late": 3}


def test_filter_reaches_a_stored_table(spark, tmp_path):
    path = str(tmp_path / "raw")
    txn(spark, TESTDATA).write.parquet(path)
    scan = incremental_scan(spark.read.parquet(path), utc_literal(datetime(2024, 1, 20)), 2)
    plan = scan.select("transaction_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(transaction_date,2024-01-18T00:00:00Z)" in plan
    assert "ReadSchema: struct<transaction_id:string,transaction_date:string>" in plan


def test_request_start():
    mark = datetime(2024, 3, 30, 21, 1, 36)
    assert requested_from(mark, 2) == datetime(2024, 3, 28, 21, 1, 36)
    assert requested_from(None, 2) is None


def test_watermark_never_moves_back(spark):
    bronze = spark.createDataFrame(
        [(datetime(2024, 1, 5),), (datetime(2024, 1, 9),)], "transaction_date timestamp_ntz"
    )

    def advanced(previous, rows):
        return advance_watermark(utc_literal(previous), rows).first()[0]

    assert advanced(None, bronze) == datetime(2024, 1, 9)
    assert advanced(datetime(2024, 1, 20), bronze) == datetime(2024, 1, 20)
    assert advanced(datetime(2024, 1, 7), bronze) == datetime(2024, 1, 9)
    assert advanced(None, bronze.where(F.lit(False))) is None
