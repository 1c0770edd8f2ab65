"""Structured Streaming over landed run documents.

Orchestrators expose finished runs; each landed file holds complete run
documents (all pages of a run in one file). This job picks files up as they
arrive and applies a timing operator to every micro-batch, so timings are
available without re-reading the whole history.

* The source is a file stream with an explicit schema (no inference).
* Each micro-batch is written to ``<out>/batch_id=<n>`` with ``overwrite``:
  a batch replayed after a failure rewrites the same folder instead of
  appending duplicates.
* Progress lives in the given checkpoint location, one per stream, so a
  restarted application goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tally.operators import timing
from tally.sources import runlogs


def _write_batch(operator: Callable[[DataFrame], DataFrame], out_dir: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        docs = batch.withColumn("page", F.coalesce(F.col("page"), F.lit(0)))
        operator(docs).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")
    return write


def stream_run_documents(
    spark: SparkSession,
    src_dir: str,
    out_dir: str,
    checkpoint_location: str,
    operator: Callable[[DataFrame], DataFrame] = timing.pivot_task_events,
    schema=runlogs.RUN_DOCUMENT,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what has landed and stops."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    writer = (
        reader.json(src_dir)
        .writeStream.foreachBatch(_write_batch(operator, out_dir))
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
