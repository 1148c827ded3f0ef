"""Dashboard tables on top of the per-batch summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import truncate


def summary_rollup(summary: DataFrame, unit: str) -> DataFrame:
    """Hourly or daily totals of every summary figure."""
    figures = [name for name in summary.columns if name != "checked_at"]
    return (
        summary.groupBy(truncate(F.col("checked_at"), unit).alias("period"))
        .agg(F.count(F.lit(1)).alias("batches"), *[F.sum(name).alias(name) for name in figures])
    )


def with_previous(summary: DataFrame, names: list[str]) -> DataFrame:
    """Add ``previous``, a struct of ``names`` from the batch before, NULL at the start.

    The lag runs inside each day; only the last row of a day crosses over, through a
    table of one row per calendar day. No window ever holds the whole history.
    """
    day = F.to_date("checked_at")
    current = F.struct(*names)
    within = summary.withColumn("_day", day).withColumn(
        "_lag", F.lag(current).over(Window.partitionBy("_day").orderBy("checked_at"))
    )
    days = summary.groupBy(day.alias("_day")).agg(F.max_by(current, F.col("checked_at")).alias("_last"))
    carried = days.select("_day", F.lag("_last").over(Window.orderBy("_day")).alias("_carried"))
    return (
        within.join(carried, "_day", "left")
        .withColumn("previous", F.coalesce("_lag", "_carried"))
        .drop("_day", "_lag", "_carried")
    )


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole)


def mention_trend(summary: DataFrame, names: list[str]) -> DataFrame:
    """Mentions of each name per batch, and the change since the batch before."""
    columns = [f"{name}_total_count" for name in names]
    series = F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            F.col(column).alias("total"),
            (F.col(column) - F.col("previous")[column]).alias("change"),
        )
        for name, column in zip(names, columns)
    ])
    return with_previous(summary, columns).select("checked_at", F.inline(series))


def negative_trend(summary: DataFrame) -> DataFrame:
    """Negative rows per batch: count, share of all rows, change since the batch before."""
    return with_previous(summary, ["negative"]).select(
        "checked_at",
        "total_posts_comments",
        "negative",
        share(F.col("negative"), F.col("total_posts_comments")).alias("negative_share"),
        (F.col("negative") - F.col("previous")["negative"]).alias("change"),
    )


def negative_alert(summary: DataFrame, min_rows: int, threshold: float) -> DataFrame:
    """Batches with at least ``min_rows`` rows and a negative share of ``threshold`` or more."""
    return negative_trend(summary).filter(
        (F.col("total_posts_comments") >= min_rows) & (F.col("negative_share") >= threshold)
    )
