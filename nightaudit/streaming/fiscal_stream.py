"""The fiscal trigger as a Structured Streaming job.

New bills (``folio_tax`` rows) arrive as parquet files. Each micro-batch is judged as a set, like the batch job, and
routed into the tables of a ``fiscal_store`` (accepted, rejected, outbox, outbox_live, log) by one commit: a batch that is
killed half-way leaves nothing visible, and a replayed one (the checkpoint re-runs the last uncommitted batch) finds its
commit and does nothing. The stored tables are opened anew for each batch (a DataFrame lists its files once): like the
trigger, a bill sees what is stored when it arrives. With ``folios`` (``plans.fiscal_state``), the rule counts and the
payments are read from what is kept per folio, and only the postings of the bills that are sent are scanned.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from nightaudit.plans.fiscal import batch_postings, few_folios
from nightaudit.plans.fiscal_routing import fiscal_store, route_batch
from nightaudit.plans.fiscal_state import kept_counts, kept_payments
from nightaudit.session import ensure_checkpoint_dir
from nightaudit.sources.schemas import HOTEL_SCHEMAS
from nightaudit.streaming.batch_store import BatchStore

BILL_SCHEMA = HOTEL_SCHEMAS["folio_tax"]


def start_fiscal_stream(spark: SparkSession, t, source_dir: str, sink_dir: str, checkpoint: str,
                        max_files_per_trigger: int = 1, available_now: bool = True, folios: BatchStore | None = None):
    """Start the stream; returns the StreamingQuery. ``sink_dir``: the root of the ``fiscal_store``. ``t``: the tables, or a
    function that opens them; tables with a ``reopened`` method are opened anew for every batch."""
    bills = (spark.readStream.schema(BILL_SCHEMA)
             .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))
    store = fiscal_store(spark, sink_dir)

    def process(batch: DataFrame, batch_id: int) -> None:
        tables = t() if callable(t) else t.reopened() if hasattr(t, "reopened") else t
        batch = batch.persist()
        # the batch's postings are read once and shared by the rule counts, items and payments;
        # bounded by the batch (maxFilesPerTrigger), recomputable if an executor is lost;
        # those of a batch with many folios are scanned by each step instead
        postings = None if folios else batch_postings(tables, batch)
        cached = postings is not None and few_folios(batch)
        if cached:
            postings.persist()
        try:
            route_batch(store, batch_id, tables, batch, small_batch=True, postings=postings,
                        counts=kept_counts(folios, batch) if folios else None,
                        payments=kept_payments(folios, batch) if folios else None)
        finally:
            if cached:
                postings.unpersist()
            batch.unpersist()

    writer = bills.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def fiscal_stream_outcomes(spark: SparkSession, t, files: int = 4) -> DataFrame:
    """Write the bills, in ranges of their reservations, as ``files`` parquet
    files into a fresh folder of the shared checkpoint area, run the stream over them until all are processed,
    and read the outcomes back from the sink."""
    root = os.path.join(ensure_checkpoint_dir(spark), f"fiscal-stream-{uuid.uuid4().hex}")
    source, sink = os.path.join(root, "bills"), os.path.join(root, "sink")
    t["folio_tax"].repartitionByRange(files, "resv_name_id").write.option("compression", "zstd").parquet(source)
    q = start_fiscal_stream(spark, t, source, sink, os.path.join(root, "checkpoint"))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    store = fiscal_store(spark, sink)
    return store.read("accepted").unionByName(store.read("rejected"))
