"""What several operators share: words, sizes, running totals and intermediate tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, shared_path

__all__ = ["materialize", "shared_path"]

BATCH = 1000
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Python gets at most 1,000 rows at once from now on: whole texts may be long.

    Operators with Python functions call this on their session; a smaller setting stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH:
        spark.conf.set(key, str(BATCH))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once a row, also if it is used often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of an id written as text; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def id_hash(column: str, seed: int = 11) -> Column:
    return F.xxhash64(F.lit(seed), F.col(column))


def running_total(df: DataFrame, key: str, value: str, out: str, block: int = 1024) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over smaller keys. ``key``: distinct, 0, 1, 2, ...

    Sums run within blocks of keys, and over the blocks' sums, so that no task sees all keys.
    """
    parts = df.withColumn("__block", F.floor(F.col(key) / block))
    before = (
        parts.groupBy("__block").agg(F.sum(value).alias("__sum"))
        .withColumn("__earlier", F.coalesce(F.sum("__sum").over(
            Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("__sum")
    )
    inside = Window.partitionBy("__block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(before, "__block").withColumn(out, F.col(out) + F.col("__earlier")).drop("__block", "__earlier")
    )


def pieces(total: float, size: float) -> int:
    """How many pieces of about ``size`` hold ``total``; 1 at least."""
    return max(1, math.ceil((total or 0) / size))
