"""The ingest run as a stream over the landing folder."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerline.contract import Contract
from ledgerline.ingest import run_ingest
from ledgerline.sources.landing import stream_landing
from ledgerline.sources.store import Store


def start_ingest_stream(
    store: Store,
    landing: str,
    checkpoint: str,
    contract: Contract,
    mode: str = "full",
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    **options: Any,
) -> StreamingQuery:
    """Feed new landing files through :func:`run_ingest`, one run per micro-batch.

    Spark remembers in ``checkpoint`` which files are done.  A batch repeated
    after a failure carries the same run id and upserts the same keys, so the
    tables end up as if it had run once.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        run_ingest(
            batch,
            store,
            contract,
            mode=mode,
            run_id=f"{query_name}-{batch_id:06d}",
            **options,
        )

    query_name = "ingest-" + checkpoint.rstrip("/").rsplit("/", 1)[-1]
    writer = (
        stream_landing(store.spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .queryName(query_name)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
