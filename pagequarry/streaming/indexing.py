"""ST1: keep an index up to date from a stream of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pagequarry.operators.index import append, merge_segments, vacuum


def index_stream(
    documents: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    vacuum_every: int = 64,
    keep: int = 8,
) -> StreamingQuery:
    """Add every new id of a streaming ``documents(doc_id, url, content)`` to the index.

    Each micro-batch becomes the segment of its batch id, so a batch that is
    repeated after a failure replaces its own segment. Ids that are indexed
    already are skipped by a join with the index, which keeps no stream state.
    Segments of like size are merged after each batch, so however many batches
    there are, few segments are live. Each ``vacuum_every`` batches, files that the last
    ``keep`` states of the index do not use are deleted.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        append(batch, path, f"batch-{batch_id:010d}")
        merge_segments(batch.sparkSession, path)
        if batch_id % vacuum_every == vacuum_every - 1:
            vacuum(batch.sparkSession, path, keep)

    writer = documents.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
