"""Column functions around the labelling service: build prompts, read replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .text import strip

# Field names the service answers with.
POST_LABEL, POST_LABEL_SPACED = "게시글_감정", "게시글 감정"
COMMENT_LABELS, COMMENT_TEXT, COMMENT_LABEL = "댓글_분석", "내용", "감정"
MISSPELLED = {"postive": "positive"}
NO_TITLE, NO_CONTENT = "제목 없음", "본문 없음"

REPLY_SCHEMA = StructType([
    StructField(POST_LABEL, StringType()),
    StructField(POST_LABEL_SPACED, StringType()),
    StructField(COMMENT_LABELS, ArrayType(StructType([
        StructField(COMMENT_TEXT, StringType()),
        StructField(COMMENT_LABEL, StringType()),
    ]))),
])


def strip_json_fence(c: Column) -> Column:
    """Remove the code fence a reply may be wrapped in."""
    return F.regexp_replace(strip(c), r"```json\s*([\s\S]*?)\s*```", "$1")


def parse_sentiment_json(c: Column, lenient: bool = False) -> Column:
    """Reply text as ``struct<label, comments array<string>>``.

    The label is NULL for text that is not a JSON object or is an empty one, and
    neutral for an object without the label. ``lenient`` also accepts the spaced
    field name and repairs the known misspelling.
    """
    text = strip_json_fence(c)
    fields = F.json_object_keys(text)
    reply = F.from_json(text, REPLY_SCHEMA)
    repair = (lambda label: F.when(label == "postive", F.lit(MISSPELLED["postive"])).otherwise(label)) if lenient else (lambda label: label)
    label = F.when(F.array_contains(fields, POST_LABEL), reply[POST_LABEL])
    if lenient:
        label = label.when(F.array_contains(fields, POST_LABEL_SPACED), reply[POST_LABEL_SPACED])
    label = repair(label.otherwise(F.lit("neutral")))
    usable = F.coalesce(F.size(fields) > 0, F.lit(False))
    comments = F.transform(reply[COMMENT_LABELS], lambda item: repair(item[COMMENT_LABEL]))
    return F.struct(
        F.when(usable, label).alias("label"),
        F.when(usable, comments).alias("comments"),
    )


def sentiment_prompt(title: Column, content: Column, comments: Column, subject: str) -> Column:
    """One request text per post: its title, body and one line per comment."""
    lines = F.array_join(F.transform(comments, lambda item: F.concat(F.lit("- "), F.coalesce(item["content"], F.lit("")))), "\n")
    task = (
        f"{subject}에 대한 게시글과 각 댓글의 감정을 positive, negative, neutral 중 하나로 판단하고 "
        f'{{"{POST_LABEL}": 감정, "{COMMENT_LABELS}": [{{"{COMMENT_TEXT}": 댓글, "{COMMENT_LABEL}": 감정}}]}} '
        "형식의 JSON으로만 답하세요."
    )
    return F.concat_ws(
        "\n",
        F.lit(task),
        F.concat(F.lit("제목: "), F.coalesce(title, F.lit(NO_TITLE))),
        F.concat(F.lit("본문: "), F.coalesce(content, F.lit(NO_CONTENT))),
        F.lit("댓글:"),
        F.coalesce(lines, F.lit("")),
    )
