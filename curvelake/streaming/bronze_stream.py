"""Arrival-driven bronze -> silver load with Structured Streaming.

Instead of a sensor polling for ``bronze/fred/<day>/*`` and a scheduled load,
two file streams, one per bronze layout, pick up every new document file once, however old;
the checkpoint records which files were processed, so a restart (or a lost
executor mid-batch) resumes without reprocessing committed files, and the
insert-if-absent merge makes a replayed micro-batch harmless.

How files are dealt to micro-batches (``max_files``) changes no row.  A micro-batch says which entities
have news; loaded are the documents of these entities that are due (``sinks.ledger``): a write that
bronze already replaces is skipped, and a document of an earlier day that still waits for its micro-batch
is loaded now, in order.  The ledger of loaded documents lets its own micro-batch pass it over.

``trigger(availableNow=True)`` processes everything that has arrived and
stops — the batch-scheduled form.  Without it the same query runs
continuously.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from curvelake.jobs import Warehouse, create_tables, load_observation_docs
from curvelake.session import staged
from curvelake.sinks import ledger as LG
from curvelake.sources import bronze as B


#: Spark forgets files older than its newest by this; a day late or years late, a file is loaded.
NO_AGE_LIMIT = "36500d"


def observation_doc_stream(spark: SparkSession, bronze_root: str, max_files: int | None = None,
                           archive: str | None = None) -> DataFrame:
    """New raw observation documents of both layouts as a stream (RAW rows).

    The source remembers every file it has seen.  ``archive`` bounds that memory: processed
    files are moved there (Spark's own ``cleanSource``), so that the folders listed, and the log, hold what is new."""
    base = bronze_root.rstrip("/")
    options = {"maxFileAge": NO_AGE_LIMIT}
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    written = spark.readStream.schema(B.WRITTEN).options(**options).parquet(f"{base}/source=fred/ingest_date=*")
    landed = spark.readStream.options(**options).text(f"{base}/fred/*/*.json", wholetext=True)
    return B.located(written, "doc").unionByName(B.located(landed, "value"))


def load_due(batch: DataFrame, bronze_root: str, wh: Warehouse, gate_before_append: bool = False) -> None:
    """Load what is due when the RAW documents of ``batch`` arrive, and enter it into the ledger."""
    spark, path = batch.sparkSession, wh.path("silver", "_ledger", "observations")
    with staged(batch.select(*LG.DOCUMENT), "arrived") as arrived:
        due = LG.due_documents(arrived, B.document_index(spark, bronze_root, "fred"), LG.read_log(spark, path, LG.DOCUMENTS))
        with staged(due, "due") as due:
            docs = LG.semi(batch, due, LG.DOCUMENT)
            waiting = LG.semi(due, arrived, LG.DOCUMENT, "left_anti")
            days = [r.ingest_date for r in waiting.select("ingest_date").distinct().collect()]   # one row per day
            if days:
                docs = docs.unionByName(LG.semi(B.raw_documents(spark, bronze_root, "fred", days), waiting, LG.DOCUMENT))
            load_observation_docs(spark, B.parse_observation_docs(docs), wh, gate_before_append)
            due.write.mode("append").parquet(path)


def stream_bronze_to_silver(spark: SparkSession, bronze_root: str, wh: Warehouse, checkpoint: str,
                            available_now: bool = True, max_files: int | None = None,
                            gate_before_append: bool = False, archive: str | None = None) -> StreamingQuery:
    """Start the load; each micro-batch is one ``load_observation_docs`` job.
    With ``gate_before_append`` a micro-batch that fails the suite stops the
    stream before it appends (the batch is retried from the checkpoint after
    the data is fixed)."""
    create_tables(spark, wh)
    docs = observation_doc_stream(spark, bronze_root, max_files, archive)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        load_due(batch, bronze_root, wh, gate_before_append)

    w = docs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(per_batch)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()

