"""The tracking table kept up to date by a stream of listing hits.

Every micro-batch is a version of the stored table (:mod:`~townvoice.sources.tracking_table`):
it writes the rows its hits change. A version names the checkpoint and the batch it is from: a
batch replayed after a failure starts from the version before its own, so it is applied
exactly once, and a new checkpoint goes on from the latest version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.tracking_table import read_table, seed_table, upsert_table

__all__ = ["read_tracking", "seed_tracking", "stream_tracking"]

read_tracking, seed_tracking = read_table, seed_table


def stream_tracking(hits: DataFrame, path: str, checkpoint: str, threshold: int = 100, rule: str = "literal", buckets: int | None = None, **trigger) -> StreamingQuery:
    """Start folding a stream of hits into the tracking table at ``path``.

    ``buckets`` counts for a table that does not exist yet.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Spark gives every checkpoint an identity of its own
        origin = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        upsert_table(spark, path, batch, threshold, rule, origin, batch_id, buckets)

    return (
        hits.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
