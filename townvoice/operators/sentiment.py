"""Exchange with the labelling service: request rows out, labels back by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.replies import parse_sentiment_json, sentiment_prompt


def sentiment_requests(nested: DataFrame, subject: str, *keys: str) -> DataFrame:
    """One prompt per post."""
    prompt = sentiment_prompt(F.col("title"), F.col("content"), F.col("comment"), subject)
    return nested.select(*(keys or ("platform", "post_id")), prompt.alias("prompt"))


def attach_sentiment(nested: DataFrame, replies: DataFrame, keys: tuple[str, ...] = ("platform", "post_id"), lenient: bool = False) -> DataFrame:
    """Put the post label and the i-th comment label back on the post.

    A post id is unique on its platform only. Of several replies to a post the greatest
    text counts, whatever their order. Labels beyond the comments are ignored and comments
    beyond the labels stay NULL; the position inside the post's own array is the key,
    so nothing depends on row order.
    """
    labelled = nested.join(reply_labels(replies, keys, lenient), list(keys), "left")
    return put_labels(labelled).select(*nested.columns)


def reply_labels(replies: DataFrame, keys: tuple[str, ...] = ("platform", "post_id"), lenient: bool = False) -> DataFrame:
    """The labels of every post that has a reply, one row per post."""
    single = replies.groupBy(*keys).agg(F.max("reply").alias("reply"))
    return single.select(*keys, parse_sentiment_json(F.col("reply"), lenient).alias("_labels"))


def put_labels(nested: DataFrame) -> DataFrame:
    """:func:`attach_sentiment` for rows that carry their labels; leaves those out."""
    label_at = lambda i: F.get("_labels.comments", i)
    return nested.withColumns({
        "sentiment": F.col("_labels.label"),
        "comment": F.transform("comment", lambda c, i: c.withField("sentiment", label_at(i))),
    }).drop("_labels")
