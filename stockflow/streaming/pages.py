"""Landed page files as a stream into a raw table.

The checkpoint of the stream remembers which files were loaded, in place of the
cursor of the batch jobs. A micro-batch is appended like a batch load, so streamed and
batch-loaded rows are one table. Its rows and its number become part of the table by one
commit, so a batch that is repeated after a failure, at whatever point, is loaded once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockflow.plans.ingest import IngestJob, pages_to_raw
from stockflow.schemas import PAGE
from stockflow.sources.tables import TableStore

def append_batch(rows: DataFrame, batch_id: int, landing: str, store: TableStore, job: IngestJob) -> None:
    """Append one micro-batch, unless the table holds it."""
    result = store.load(job.table, rows, batch=(landing, batch_id))
    if not result.ok:
        raise RuntimeError(result.error_message)
    store.join_small_parts(job.table)


def stream_pages_to_raw(
    spark: SparkSession,
    landing: str,
    store: TableStore,
    job: IngestJob,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load all page files not loaded yet, then stop. Wait with ``awaitTermination``."""
    reader = spark.readStream.schema(PAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = pages_to_raw(reader.json(landing), job, F.current_timestamp())
    return (
        rows.writeStream.foreachBatch(lambda df, batch_id: append_batch(df, batch_id, landing, store, job))
        .option("checkpointLocation", store.path(f"{job.table}_checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
