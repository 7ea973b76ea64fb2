"""The fixture's stored tables: each stage is written once and read by many queries."""

from __future__ import annotations

from contextlib import suppress
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.contract import Contract
from ledgerline.ingest import PublishBlocked, rebuild_summary, run_ingest, upsert_bronze
from ledgerline.operators.dedup import duplicate_groups, flag_duplicates, repeated_hashes
from ledgerline.operators.routing import (
    DEFAULT_SOURCE,
    bronze_rows,
    check_payloads,
    check_table,
    quarantine_rows,
    table_payload,
)
from ledgerline.plans.fixture import FIRST_LOAD_END, load, payload_deliveries, payloads, txn
from ledgerline.plans.staging import stg_transactions
from ledgerline.plans.summary import daily_account_summary
from ledgerline.session import materialize, prepare_session, scratch_path
from ledgerline.sources.landing import read_landing
from ledgerline.sources.store import Store
from ledgerline.streaming.ingest_stream import start_ingest_stream

AS_OF = datetime(2024, 4, 1)
RUN_ID = "run-1"
LOOKBACK_DAYS = 2
# Landing files are packed; a packed file is read by one task, so it holds so many lines.
FILE_LINES = 50_000


def _write_landing(lines: DataFrame, root: str) -> None:
    packed = lines.write.option("maxRecordsPerFile", FILE_LINES).partitionBy("delivery")
    packed.text(root, compression="gzip")


@dataclass(frozen=True, eq=False)
class Warehouse:
    spark: SparkSession
    sf_dir: str

    @cached_property
    def contract(self) -> Contract:
        return Contract.default(self.spark)

    @property
    def txn(self) -> DataFrame:
        return txn(self.spark, self.sf_dir)

    @property
    def checked_now(self) -> DataFrame:
        return check_table(self.txn, self.contract).withColumn(
            "payload", table_payload(self.contract)
        )

    @cached_property
    def checked(self) -> DataFrame:
        return materialize(self.checked_now, "checked")

    @cached_property
    def checked_payloads(self) -> DataFrame:
        return materialize(
            check_payloads(payloads(self.spark, self.sf_dir), self.contract), "payloads"
        )

    @property
    def valid(self) -> DataFrame:
        return bronze_rows(self.checked, self.contract, DEFAULT_SOURCE, RUN_ID, AS_OF)

    @cached_property
    def bronze(self) -> DataFrame:
        return materialize(self.valid, "bronze")

    @property
    def quarantine(self) -> DataFrame:
        return quarantine_rows(self.checked, DEFAULT_SOURCE, RUN_ID, AS_OF)

    @cached_property
    def flagged(self) -> DataFrame:
        repeated = materialize(repeated_hashes(self.bronze), "repeated")
        groups = materialize(duplicate_groups(self.bronze, repeated=repeated), "groups")
        return materialize(flag_duplicates(self.bronze, groups=groups), "flagged")

    @cached_property
    def order_lines(self) -> DataFrame:
        """Another table with repeated keys: line numbers repeat within an order."""
        lines = load(self.spark, self.sf_dir, "lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"),
            "l_shipdate",
            F.concat_ws(
                "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
            ).alias("line_id"),
        )
        return materialize(lines.distinct(), "lines")

    @property
    def staging(self) -> DataFrame:
        return stg_transactions(self.flagged)

    @cached_property
    def summary(self) -> DataFrame:
        return materialize(daily_account_summary(self.staging, AS_OF), "summary")

    @cached_property
    def landing(self) -> str:
        """The records as JSON lines in two folders, as two deliveries."""
        root = scratch_path(self.spark, "landing")
        records = self.txn.select(
            table_payload(self.contract).alias("value"), "transaction_date"
        )
        first = F.col("transaction_date") < FIRST_LOAD_END
        delivery = F.when(first, 1).otherwise(2).alias("delivery")
        _write_landing(records.select("value", delivery), root)
        return root

    @cached_property
    def payload_landing(self) -> str:
        """The JSON records with their defects; what is no object arrives second."""
        root = scratch_path(self.spark, "payload-landing")
        records = payload_deliveries(self.spark, self.sf_dir)
        _write_landing(records.withColumnRenamed("payload", "value"), root)
        return root

    @cached_property
    def payload_loads(self) -> Store:
        """The two deliveries in two runs, the second one incremental over what is new."""
        store = self._new_store("payloads")
        for n in (1, 2):
            # The second delivery is there, but a run names only what it is to load.
            records = read_landing(self.spark, f"{self.payload_landing}/delivery={n}")
            run_ingest(
                records,
                store,
                self.contract,
                mode="incremental",
                lookback_days=LOOKBACK_DAYS,
                run_id=f"load-{n}",
                as_of=AS_OF,
            )
        return store

    @property
    def landed(self) -> DataFrame:
        return read_landing(self.spark, f"{self.landing}/delivery=*")

    def _new_store(self, name: str) -> Store:
        return Store(self.spark, scratch_path(self.spark, name))

    @cached_property
    def full_store(self) -> Store:
        store = self._new_store("full")
        run_ingest(self.landed, store, self.contract, run_id="full-1", as_of=AS_OF)
        rebuild_summary(store, AS_OF)
        return store

    @cached_property
    def replayed_store(self) -> Store:
        """Two loads of the same records; the second one refreshes what it replays."""
        store = self._new_store("replayed")
        for n in (1, 2):
            run_ingest(
                self.landed, store, self.contract, run_id=f"replay-{n}", as_of=AS_OF
            )
        return store

    @cached_property
    def two_loads(self) -> tuple[Store, DataFrame]:
        """A first load, an incremental one over everything, and both reports."""
        store = self._new_store("incremental")
        first = read_landing(self.spark, f"{self.landing}/delivery=1")
        reports = [
            run_ingest(
                records,
                store,
                self.contract,
                mode="incremental",
                lookback_days=LOOKBACK_DAYS,
                summary=True,
                run_id=run_id,
                as_of=as_of,
            )
            for records, run_id, as_of in (
                (first, "load-1", datetime(2024, 4, 1, 1)),
                (self.landed, "load-2", datetime(2024, 4, 1, 2)),
            )
        ]
        return store, reports[0].unionByName(reports[1])

    @cached_property
    def moved_store(self) -> Store:
        """All valid rows, then the pending ones again, dated a day later."""
        store = self._new_store("moved")
        upsert_bronze(store, self.bronze, "fail")
        later = self.bronze.where("status = 'pending'").withColumns(
            {
                "transaction_date": F.col("transaction_date") + F.make_dt_interval(days=F.lit(1)),
                "ingestion_run_id": F.lit("run-2"),
            }
        )
        upsert_bronze(store, later, "fail")
        return store

    @cached_property
    def blocked_store(self) -> Store:
        """A first load, and one with members outside the contract, which is held back."""
        store = self._new_store("blocked")
        first = read_landing(self.spark, f"{self.landing}/delivery=1")
        run_ingest(first, store, self.contract, run_id="load-1", as_of=datetime(2024, 4, 1, 1))
        drifted = read_landing(self.spark, f"{self.payload_landing}/delivery=1")
        with suppress(PublishBlocked):
            run_ingest(
                drifted, store, self.contract, run_id="load-2", as_of=datetime(2024, 4, 1, 2),
                on_conflict="latest", on_drift="fail",
            )
        return store

    @cached_property
    def streamed_store(self) -> Store:
        store = self._new_store("streamed")
        query = start_ingest_stream(
            store,
            f"{self.landing}/delivery=*",
            scratch_path(self.spark, "stream-checkpoint"),
            self.contract,
            as_of=AS_OF,
        )
        query.awaitTermination()
        return store

    @property
    def daily_runs(self) -> DataFrame:
        """An audit as if every day of records had been one run."""
        checked = self.checked.select(
            F.substring("transaction_date", 1, 10).try_cast("date").alias("day"),
            (F.size("violations") == 0).alias("ok"),
            "transaction_id",
            "transaction_date",
        ).where("day IS NOT NULL")
        duplicates = (
            self.flagged.groupBy(F.col("transaction_date").cast("date").alias("day"))
            .agg(F.count_if("is_duplicate").alias("records_duplicate_flagged"))
        )
        per_day = checked.groupBy("day").agg(
            F.count("*").alias("records_fetched"),
            F.count_if("ok").alias("records_valid"),
            F.count_if(~F.col("ok")).alias("records_quarantined"),
            F.max(F.when(F.col("ok"), F.substring("transaction_date", 1, 19)))
            .try_cast("timestamp_ntz")
            .alias("new_watermark"),
        )
        start = F.col("day").cast("timestamp_ntz")
        runs = per_day.join(duplicates, "day", "left").select(
            F.date_format("day", "yyyyMMdd").alias("run_id"),
            F.lit(DEFAULT_SOURCE).alias("source_name"),
            F.lit("full").alias("run_mode"),
            F.lit(None).cast("timestamp_ntz").alias("requested_from"),
            start.alias("started_at"),
            # A run takes a second per record.
            (start + F.make_dt_interval(secs=F.col("records_fetched"))).alias("ended_at"),
            F.when(F.col("records_valid") > 0, "success").otherwise("failed").alias("status"),
            "records_fetched",
            "records_valid",
            "records_quarantined",
            F.coalesce("records_duplicate_flagged", F.lit(0)).alias("records_duplicate_flagged"),
            F.col("records_valid").alias("records_new"),
            F.coalesce("records_duplicate_flagged", F.lit(0)).alias("records_duplicate_in_batch"),
            F.lit(0).cast("long").alias("records_late_rejected"),
            F.lit(None).cast("timestamp_ntz").alias("previous_watermark"),
            "new_watermark",
            F.lit(None).cast("string").alias("error_message"),
        )
        return runs.select(schemas.RUNS.fieldNames())


@lru_cache(maxsize=None)
def _opened(application: str, session: int, sf_dir: str) -> list[Warehouse]:
    return []


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The stored tables of one session and data folder."""
    prepare_session(spark)
    slot = _opened(spark.sparkContext.applicationId, id(spark), sf_dir)
    if not slot:
        slot.append(Warehouse(spark, sf_dir))
    return slot[0]
