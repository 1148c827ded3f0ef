"""Summaries over a growing landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..lexicon import DEFAULT_LEXICON, Lexicon
from ..operators.summary import mention_totals, sentiment_metrics
from ..schemas import POSTS_SCHEMA
from ..sources.summary_table import merge_summary


def landing_stream(spark: SparkSession, path: str, glob: str = "*.parquet", files_per_trigger: int | None = None) -> DataFrame:
    """Rows of new landing files, of any batch, posts and comments alike."""
    reader = spark.readStream.schema(POSTS_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_summary(rows: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON, lateness: str = "10 minutes", every: str = "5 minutes") -> DataFrame:
    """One summary per ``every`` window of batch time; later rows than ``lateness`` are dropped.

    Each task sends one partial row per window, so the state holds a row per open window
    whatever the volume.
    """
    timed = rows.withColumn("checked_at", F.col("checked_at").cast("timestamp"))
    return (
        timed.withWatermark("checked_at", lateness)
        .groupBy(F.window("checked_at", every))
        .agg(*sentiment_metrics(), *mention_totals(timed, lexicon))
        .select(F.col("window.start").cast("timestamp_ntz").alias("period"), "*")
        .drop("window")
    )


def stream_to_table(rows: DataFrame, path: str, checkpoint: str, lexicon: Lexicon = DEFAULT_LEXICON, lateness: str = "10 minutes",
                    every: str = "5 minutes", **trigger) -> StreamingQuery:
    """Start merging a stream of landing rows into the summary table at ``path``, in update mode.

    Unlike :func:`stream_summary` it shows periods before they are closed, rewrites only the
    days that rows arrive for, and keeps late rows (:mod:`~townvoice.sources.summary_table`).
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        origin = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        merge_summary(spark, path, batch, lexicon, lateness, every, origin, batch_id)

    return (
        rows.writeStream.outputMode("update").foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
