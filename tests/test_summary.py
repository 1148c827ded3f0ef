"""Summaries: golden rows, invariants, and agreement of the summary forms."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from townvoice.lexicon import DEFAULT_LEXICON, names
from townvoice.operators import rollup as R
from townvoice.operators import summary as S
from townvoice.schemas import COMMENTS_SCHEMA, POSTS_SCHEMA
from townvoice.sources import adapters as A

BATCH = "2025-02-24 13:45:03"


def contents(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, content string")


def flags(spark, text):
    row = S.keyword_flags(contents(spark, text)).first().asDict()
    return {name for name in names(DEFAULT_LEXICON) if row[f"{name}_count"]}


def test_lexicon_shape():
    assert [len(names(DEFAULT_LEXICON, c)) for c in ("accident", "brand", "model", "ev_issue")] == [20, 6, 5, 14]
    assert len(set(names(DEFAULT_LEXICON))) == 45


@pytest.mark.parametrize("text, expected", [
    (None, set()),
    ("충전포트 화재 화재", {"fire", "charging", "charging_port_failure"}),
    ("BMW", set()),
    ("bmw", {"bmw"}),
    ("전원 차단", {"power_cutoff"}),
    ("전원차단", set()),
    ("급차선변경과 타이어펑크, G80 배터리", {"lane_change", "tire_blowout", "genessis", "battery"}),
])
def test_flags(spark, text, expected):
    assert flags(spark, text) == expected


def korean(spark):
    rows = [
        ("a", "기아 화재", 10, "positive", "2025-02-24 00:00:03"),
        ("a", "현대 화재 배터리", 20, "negative", "2025-02-24 00:00:03"),
        ("b", None, None, None, "2025-02-24 00:05:03"),
        ("b", "테슬라 충전포트", 5, "negative", "2025-02-24 00:05:03"),
        (None, "충전", None, "neutral", "2025-02-25 10:05:03"),
    ]
    df = spark.createDataFrame(rows, "platform string, content string, view bigint, sentiment string, t string")
    return df.withColumn("checked_at", F.col("t").cast("timestamp_ntz")).drop("t")


def test_batch_summary(spark):
    row = S.batch_summary(korean(spark), BATCH).first().asDict()
    assert list(row)[:6] == ["checked_at", "total_views", "total_posts_comments", "positive", "neutral", "negative"]
    assert len(row) == 51
    assert row["checked_at"] == datetime(2025, 2, 24, 13, 45, 3)
    assert (row["total_views"], row["total_posts_comments"], row["positive"], row["neutral"], row["negative"]) == (35, 5, 1, 1, 2)
    assert (row["fire_total_count"], row["charging_total_count"], row["charging_port_failure_total_count"]) == (2, 2, 1)
    assert row["traffic_total_count"] == 0


def test_empty_batch_has_a_row(spark):
    row = S.batch_summary(korean(spark).limit(0), BATCH).first()
    assert (row.total_views, row.total_posts_comments, row.positive, row.fire_total_count) == (None, 0, None, None)
    v1 = S.sentiment_summary_v1(korean(spark).limit(0), korean(spark).limit(0), BATCH).first()
    assert (v1.total_views, v1.total_posts_comments, v1.positive) == (None, 0, 0)


def test_all_labels_missing(spark):
    row = S.sentiment_summary(korean(spark).filter("sentiment is null")).first()
    assert (row.total_posts_comments, row.positive, row.neutral, row.negative) == (1, None, None, None)


def test_history_rows_equal_batch_summaries(spark):
    df = korean(spark)
    history = {r.checked_at: r.asDict() for r in S.summary_history(df).collect()}
    assert len(history) == 3
    for at, row in history.items():
        assert S.batch_summary(df.filter(F.col("checked_at") == F.lit(str(at)).cast("timestamp_ntz")), str(at)).first().asDict() == row


def test_long_form_and_category_totals_agree(spark):
    df = korean(spark)
    wide = S.batch_summary(df, BATCH).first().asDict()
    long = {r["name"]: r["total"] for r in S.keyword_long(df).collect()}
    assert long == {name: wide[f"{name}_total_count"] for name in names(DEFAULT_LEXICON)}
    parts = {}
    for total in (S.accident_totals, S.brand_totals, S.model_totals, S.ev_issue_totals):
        parts.update(total(df).first().asDict())
    assert parts == {k: v for k, v in wide.items() if k.endswith("_total_count")}


def test_v1_agrees(spark, sf_dir):
    posts, comments = A.posts(spark, sf_dir), A.comments(spark, sf_dir)
    merged = S.union_posts_comments(posts, comments)
    assert S.sentiment_summary(merged).first().asDict() == {
        k: v for k, v in S.sentiment_summary_v1(posts, comments, BATCH).first().asDict().items() if k != "checked_at"
    }


def test_invariants(spark, sf_dir):
    merged = S.union_posts_comments(A.posts(spark, sf_dir), A.comments(spark, sf_dir)).withColumn("kind", F.col("platform").isNull())
    total = S.batch_summary(merged, BATCH, A.LATIN_LEXICON).drop("checked_at").first().asDict()
    assert total["positive"] + total["neutral"] + total["negative"] <= total["total_posts_comments"]
    assert all(v <= total["total_posts_comments"] for k, v in total.items() if k.endswith("_total_count"))
    groups = merged.groupBy("platform", "kind").agg(*S.sentiment_metrics(), *S.mention_totals(merged, A.LATIN_LEXICON))
    sums = groups.agg(*[F.sum(name).alias(name) for name in total]).first().asDict()
    assert sums == total


def test_align_columns(spark):
    posts = spark.createDataFrame([], POSTS_SCHEMA)
    comments = spark.createDataFrame([], COMMENTS_SCHEMA)
    a, b = S.align_columns(posts, comments)
    assert a.columns == b.columns == sorted(POSTS_SCHEMA.names)
    assert dict(a.dtypes) == dict(b.dtypes)


def summary(spark):
    rows = [
        ("2025-02-24 23:50:03", 10, 1), ("2025-02-24 23:55:03", 10, 4), ("2025-02-25 00:00:03", 0, 0),
        ("2025-02-27 08:00:03", 20, 10), ("2025-02-27 08:05:03", 2, 2),
    ]
    df = spark.createDataFrame(rows, "t string, total_posts_comments bigint, negative bigint")
    return df.select(F.col("t").cast("timestamp_ntz").alias("checked_at"), "total_posts_comments", "negative")


def test_negative_trend_crosses_days(spark):
    got = [tuple(r) for r in R.negative_trend(summary(spark)).orderBy("checked_at").collect()]
    assert [(n, s, c) for _, _, n, s, c in got] == [(1, 0.1, None), (4, 0.4, 3), (0, None, -4), (10, 0.5, 10), (2, 1.0, -8)]


def test_negative_alert(spark):
    got = R.negative_alert(summary(spark), min_rows=5, threshold=0.4).orderBy("checked_at").collect()
    assert [r.negative for r in got] == [4, 10]


def test_rollup(spark):
    hours = {str(r.period): (r.batches, r.negative) for r in R.summary_rollup(summary(spark), "hour").collect()}
    assert hours == {"2025-02-24 23:00:00": (2, 5), "2025-02-25 00:00:00": (1, 0), "2025-02-27 08:00:00": (2, 12)}
    assert R.summary_rollup(summary(spark), "day").count() == 3
    with pytest.raises(ValueError):
        R.summary_rollup(summary(spark), "week")


def test_mention_trend(spark):
    df = S.summary_history(korean(spark))
    got = {(str(r.checked_at), r.name): (r.total, r.change) for r in R.mention_trend(df, ["kia", "tesla"]).collect()}
    assert got[("2025-02-24 00:00:03", "kia")] == (1, None)
    assert got[("2025-02-24 00:05:03", "kia")] == (0, -1)
    assert got[("2025-02-24 00:05:03", "tesla")] == (1, 1)
    assert got[("2025-02-25 10:05:03", "tesla")] == (0, -1)


def test_plan_reads_three_columns_and_aggregates_before_the_shuffle(spark, sf_dir):
    """Column pruning reaches the scan; tasks exchange one partial row each."""
    plan = S.batch_summary(A.posts(spark, sf_dir), BATCH)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "documents" in line)
    assert "lang" not in scan.split("ReadSchema")[1] and "text" in scan.split("ReadSchema")[1]
    assert "partial_sum" in plan
