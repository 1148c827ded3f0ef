"""Curated output folders and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .landing import batch_dir


def write_curated(df: DataFrame, root: str, checked_at: str, files: int | None = None, kind: str = "posts") -> str:
    """Overwrite a batch's curated rows. ``files`` asks for a fixed number of files."""
    path = f"{root}/{kind}/{batch_dir(checked_at)}/{kind}.parquet"
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").parquet(path)
    return path


def write_summary(summary: DataFrame, root: str, checked_at: str) -> str:
    """Overwrite the batch's one-row summary, one file."""
    path = f"{root}/summary/{batch_dir(checked_at)}/summary.parquet"
    summary.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_append(df: DataFrame, table: str, idempotent: bool = False) -> None:
    """Append rows to a warehouse table (a Parquet folder), partitioned by batch date.

    ``idempotent`` partitions by batch and replaces the batches found in ``df`` instead,
    so that a repeated load leaves the table as after the first. A table is loaded in
    one of the two modes only. Rows are gathered by partition first, which keeps files
    few; a huge partition is split.
    """
    parts = df.withColumn("batch_date", F.to_date("checked_at"))
    if not idempotent:
        parts.hint("rebalance", "batch_date").write.mode("append").partitionBy("batch_date").parquet(table)
        return
    keys = ["batch_date", "batch_time"]
    time = F.translate(F.substring(F.col("checked_at").cast("string"), 12, 8), ":", "")
    batches = parts.withColumn("batch_time", time).hint("rebalance", *keys)
    batches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(table)


def store_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Store rows in the catalogue as ``table``, bucketed and sorted by ``keys``; returns the table.

    Two tables of equal keys and number of buckets join without a shuffle: rows move once, when
    they are stored, however often they are joined. One task writes a bucket's file.
    """
    spread = df.repartition(buckets, *keys)
    spread.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)
