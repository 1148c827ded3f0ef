"""Filters over result listings: rows (source, keyword, page, pos, post_id, created_at)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import NOT_KNOWN

SEARCH = ("source", "keyword")


def join_per_listing(df: DataFrame, per_listing: DataFrame, salts: int | None = None) -> DataFrame:
    """Left join with one row per listing, a listing's rows spread over ``salts`` groups.

    By default there are as many groups as shuffle partitions.

    The small side is repeated per group. It is shuffled for the join alone, so adaptive
    execution can still broadcast it, or split a group further.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    repeated = per_listing.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*SEARCH, "_salt"], "left").drop("_salt")


def listing_window(df: DataFrame, start: Column, end: Column, mode: str = "take_while") -> DataFrame:
    """Rows created between ``start`` and ``end``, both included.

    ``take_while`` reads a listing from the top and stops at the first row older than
    ``start``; ``filter`` looks at every row. The stop position of a listing is a plain
    minimum, so a listing of any length is never sorted or gathered in one task.
    """
    created = F.col("created_at")
    inside = (created >= start) & (created <= end)
    if mode == "filter":
        return df.filter(inside)
    if mode != "take_while":
        raise ValueError(f"mode must be take_while or filter, not {mode!r}")
    stops = df.filter(created < start).groupBy(*SEARCH).agg(F.min("pos").alias("_stop"))
    kept = join_per_listing(df.filter(inside), stops)
    return kept.filter(F.col("_stop").isNull() | (F.col("pos") < F.col("_stop"))).drop("_stop").select(*df.columns)


def category_filter(df: DataFrame) -> DataFrame:
    """Without the picture board and any humour board."""
    category = F.col("category")
    return df.filter(~((category == "내차사진") | category.contains("유머")))


def drop_repeated_pages(df: DataFrame) -> DataFrame:
    """Keep a listing up to the first page showing the same posts as the page before.

    Two pages are equal when they have as many distinct posts as they share. Every post
    meets the page before by hash of (listing, page, post), so one huge listing or page
    spreads over all tasks.
    """
    pages = df.select(*SEARCH, "page").distinct()
    following = pages.withColumn("_next", F.lead("page").over(Window.partitionBy(*SEARCH).orderBy("page")))
    shown = df.select(*SEARCH, "page", "post_id").distinct().join(following, [*SEARCH, "page"])
    sides = F.array(
        F.struct(F.col("page").alias("page"), F.lit(1).alias("here"), F.lit(0).alias("before")),
        F.struct(F.col("_next").alias("page"), F.lit(0).alias("here"), F.lit(1).alias("before")),
    )
    first_repeat = (
        shown.select(*SEARCH, "post_id", F.inline(sides))
        .filter(F.col("page").isNotNull())
        .groupBy(*SEARCH, "page", "post_id")
        .agg(F.max("here").alias("here"), F.max("before").alias("before"))
        .groupBy(*SEARCH, "page")
        .agg(
            F.sum("here").alias("here"),
            F.sum("before").alias("before"),
            F.sum(F.col("here") * F.col("before")).alias("both"),
        )
        .filter((F.col("here") == F.col("both")) & (F.col("before") == F.col("both")))
        .groupBy(*SEARCH)
        .agg(F.min("page").alias("_repeat"))
    )
    kept = join_per_listing(df, first_repeat)
    return kept.filter(F.col("_repeat").isNull() | (F.col("page") <= F.col("_repeat"))).select(*df.columns)


def force_refresh_sentinel(df: DataFrame) -> DataFrame:
    """Counts a listing does not show become the not-known mark, status CHANGED."""
    return df.withColumns({
        "view": F.lit(NOT_KNOWN),
        "comment_count": F.lit(NOT_KNOWN),
        "status": F.lit("CHANGED"),
    })
