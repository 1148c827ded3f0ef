"""From nested scraped posts to the flat posts and comments tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.replies import NO_CONTENT, NO_TITLE
from ..functions.text import board_letter, join_keywords, lenient_int, strict_int
from ..schemas import COMMENTS_SCHEMA, POSTS_SCHEMA

DELETED_COMMENT = "삭제된 댓글입니다"  # Fixed value: what a deleted comment shows.
COMMENT_FIELDS = ("created_at", "content", "like", "dislike")


def attach_batch(df: DataFrame, platform: str | None, checked_at: str) -> DataFrame:
    """Overwrite platform and batch time with the batch's; drop crawl bookkeeping.

    ``platform=None`` keeps the platform column the rows already have.
    """
    df = df.drop("id", "status").withColumn("checked_at", F.lit(checked_at).cast("timestamp_ntz"))
    return df if platform is None else df.withColumn("platform", F.lit(platform))


def keep_parsed(df: DataFrame) -> DataFrame:
    """Only posts whose detail page was read."""
    return df.filter(F.col("status") == "UNCHANGED")


def count_comments(df: DataFrame) -> DataFrame:
    """comment_count = length of the comment list, 0 without a list."""
    count = F.when(F.col("comment").isNull(), 0).otherwise(F.size("comment"))
    return df.withColumn("comment_count", count)


def explode_comments(nested: DataFrame, *keys: str) -> DataFrame:
    """One row per comment with its 0-based position and the post's ``keys``."""
    return nested.select(*keys, F.posexplode("comment").alias("pos", "_comment")).select(*keys, "pos", "_comment.*")


def flatten_comments(nested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Posts without their comments, and the comments with their post's key and batch."""
    return nested.drop("comment"), explode_comments(nested, "platform", "post_id", "checked_at")


def land_columns(nested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed posts and comments in landing layout. A post without readable counts fails."""
    posts, comments = flatten_comments(nested)
    posts = posts.withColumns({
        "like": lenient_int(F.col("like")),
        "dislike": lenient_int(F.col("dislike")),
        "comment_count": strict_int(F.col("comment_count")),
        "view": strict_int(F.col("view")),
        "keywords": join_keywords(F.col("keywords")),
    })
    comments = comments.withColumns({name: lenient_int(F.col(name)) for name in ("like", "dislike")})
    return posts.select(*POSTS_SCHEMA.names), comments.select(*COMMENTS_SCHEMA.names)


def split_strict(df: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``names`` are all integers, and the rest, instead of failing the job."""
    good = F.lit(True)
    for name in names:
        good = good & lenient_int(F.col(name)).isNotNull()
    return df.filter(good), df.filter(~good)


def drop_blocked_comments(df: DataFrame) -> DataFrame:
    """Remove blocked comments; blank out deleted ones, which still count as comments."""
    deleted = F.coalesce(F.contains("content", F.lit(DELETED_COMMENT)), F.lit(False))
    kept = df.filter(~F.coalesce(F.col("blocked"), F.lit(False))).drop("blocked")
    blank = {name: F.when(~deleted, F.col(name)) for name in COMMENT_FIELDS if name in kept.columns}
    return kept.withColumns(blank)


CRAWL_STATE = ("view", "comment_count", "created_at")


def default_missing(details: DataFrame, tracking: DataFrame) -> DataFrame:
    """Fill what a detail page lacked: texts by a fixed word, counts and time from the
    crawl state, like by 0, comment times from their post."""
    joined = details.join(tracking.select("platform", "url", *crawl_state()), ["platform", "url"], "left")
    return fill_missing(joined)


def crawl_state() -> list[Column]:
    """The fields of a tracking row that :func:`fill_missing` looks at."""
    return [F.col(name).alias(f"_{name}") for name in CRAWL_STATE]


def fill_missing(details: DataFrame) -> DataFrame:
    """:func:`default_missing` for rows that carry their crawl state; leaves it out."""
    filled: dict[str, Column] = {
        "title": F.coalesce("title", F.lit(NO_TITLE)),
        "content": F.coalesce("content", F.lit(NO_CONTENT)),
        "like": F.coalesce("like", F.lit(0).cast(details.schema["like"].dataType)),
    }
    for name in CRAWL_STATE:
        filled[name] = F.coalesce(name, F.col(f"_{name}").cast(details.schema[name].dataType))
    if "comment" in details.columns:
        filled["comment"] = F.transform(
            "comment", lambda c: c.withField("created_at", F.coalesce(c["created_at"], filled["created_at"]))
        )
    return details.withColumns(filled).drop(*[f"_{name}" for name in CRAWL_STATE])


def salt_post_id(df: DataFrame, letters: dict[str, str] | None = None) -> DataFrame:
    """Prefix post_id with its board's letter; posts of unknown boards are dropped."""
    letter = board_letter(F.col("category"), letters)
    return df.withColumn("_letter", letter).filter(F.col("_letter").isNotNull()).withColumn(
        "post_id", F.concat("_letter", "post_id")
    ).drop("_letter")
