"""Streams: read what is available once, then stop (S2); quarantine on
every micro-batch (Q1 on streams).

``trigger(availableNow=True)`` replaces the reference's single driver-side
``poll``: executors read everything available at start, in bounded
micro-batches, the checkpoint stores the position, and a later run resumes
from it.  No record passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.quality import write_bad_records


def run_available_now(stream: DataFrame, sink_path: str, checkpoint: str,
                      fmt: str = "parquet", **options: str) -> StreamingQuery:
    """Write everything currently available to ``sink_path`` and stop.

    The file sink is exactly-once: it commits each batch in its metadata log,
    so a re-run with the same checkpoint adds only new input.
    """
    writer = (stream.writeStream.format(fmt).option("checkpointLocation", checkpoint)
                    .option("path", sink_path).outputMode("append")
                    .trigger(availableNow=True))
    for k, v in options.items():
        writer = writer.option(k, v)
    query = writer.start()
    query.awaitTermination()
    return query


def quarantine_batch(batch: DataFrame, batch_id: int, target: str,
                     condition: str | Column | None = None) -> bool:
    """One micro-batch of :func:`quarantine_stream`: the bad rows go to
    ``target/batch_id=<id>``, replacing what an earlier attempt of the same
    batch wrote.  Idempotent, so a replayed batch is never counted twice."""
    return write_bad_records(batch, f"{target}/batch_id={batch_id}", condition,
                             mode="overwrite")


def quarantine_stream(stream: DataFrame, target: str, checkpoint: str,
                      condition: str | Column | None = None,
                      available_now: bool = True) -> StreamingQuery:
    """Q1 per micro-batch: bad rows of batch ``n`` go to ``target/batch_id=n``.

    Each batch overwrites its own folder, so a retried batch replaces its
    earlier attempt instead of appending twice; batches without bad rows
    write nothing.  The batch path's cache scope and emptiness gate apply, so
    a micro-batch is read once for probe and write.
    """
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        quarantine_batch(batch, batch_id, target, condition)

    writer = (stream.writeStream.foreachBatch(per_batch)
                    .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
