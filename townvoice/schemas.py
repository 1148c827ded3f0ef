"""Table contracts. Times are zone-less local times (KST)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


TEXT, LONG, INT, TIME = StringType(), LongType(), IntegerType(), TimestampNTZType()

POSTS_SCHEMA = _schema(
    ("platform", TEXT), ("title", TEXT), ("post_id", TEXT), ("url", TEXT),
    ("content", TEXT), ("view", LONG), ("created_at", TIME), ("like", LONG),
    ("dislike", LONG), ("comment_count", LONG), ("keywords", TEXT),
    ("sentiment", TEXT), ("checked_at", TIME),
)

# platform is ours: post_id alone is not unique across platforms.
COMMENTS_SCHEMA = _schema(
    ("platform", TEXT), ("created_at", TIME), ("content", TEXT), ("like", LONG),
    ("dislike", LONG), ("post_id", TEXT), ("sentiment", TEXT), ("checked_at", TIME),
)

NESTED_COMMENT = _schema(
    ("created_at", TIME), ("content", TEXT), ("like", TEXT), ("dislike", TEXT),
    ("sentiment", TEXT),
)

NESTED_SCHEMA = _schema(
    ("title", TEXT), ("post_id", TEXT), ("url", TEXT), ("content", TEXT),
    ("view", TEXT), ("created_at", TIME), ("like", TEXT), ("dislike", TEXT),
    ("comment_count", TEXT), ("keywords", ArrayType(TEXT)), ("sentiment", TEXT),
    ("status", TEXT), ("comment", ArrayType(NESTED_COMMENT)),
)

TRACKING_SCHEMA = _schema(
    ("platform", TEXT), ("url", TEXT), ("keywords", ArrayType(TEXT)),
    ("post_id", TEXT), ("status", TEXT), ("comment_count", INT),
    ("created_at", TIME), ("checked_at", TIME), ("view", INT),
)

HITS_SCHEMA = _schema(
    ("platform", TEXT), ("url", TEXT), ("post_id", TEXT), ("status", TEXT),
    ("comment_count", INT), ("view", INT), ("created_at", TIME),
    ("checked_at", TIME), ("keyword", TEXT), ("seq", LONG),
)

STATUSES = ("CHANGED", "UNCHANGED", "FAILED", "BANNED")
SENTIMENTS = ("positive", "neutral", "negative")
NOT_KNOWN = -999  # a count nobody has read yet; forces a refresh
