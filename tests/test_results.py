"""Results that must not depend on order, settings or the shape of a batch."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from townvoice import jobs
from townvoice.operators import summary
from townvoice.operators.sentiment import attach_sentiment
from townvoice.operators.tracking import tracking_upsert
from townvoice.schemas import HITS_SCHEMA, POSTS_SCHEMA
from townvoice.sources import landing
from townvoice.sources import pages as G
from townvoice.streaming import tracking as stream
from townvoice.sources.landing import batch_dir


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def hits(spark, rows):
    raw = spark.createDataFrame(rows, "keyword string, view int, comment_count int, seq bigint")
    return raw.select(
        F.lit("clien").alias("platform"), F.lit("/u").alias("url"), F.lit("1").alias("post_id"), F.lit("CHANGED").alias("status"),
        "comment_count", "view", ntz("2025-01-01 00:00:00").alias("created_at"), ntz("2025-01-02 00:00:00").alias("checked_at"),
        "keyword", "seq").select(*HITS_SCHEMA.names)


def test_hits_of_one_time_do_not_depend_on_their_order(spark):
    rows = [("a", 1000, 5, None), ("a", 880, 5, None), ("a", 800, 5, None), ("b", 900, 5, None)]
    orders = (rows, rows[::-1], rows[2:] + rows[:2])
    found = {(r.view, *sorted(r.keywords)) for order in orders for r in tracking_upsert(None, hits(spark, order)).collect()}
    assert len(found) == 1


def test_labels_go_to_the_post_of_their_platform(spark):
    comment = "array<struct<created_at: timestamp_ntz, content: string, like: string, dislike: string, sentiment: string>>"
    nested = spark.createDataFrame([("clien", "7", None, []), ("dcinside", "7", None, [])], f"platform string, post_id string, sentiment string, comment {comment}")
    reply = '{"게시글_감정": "%s", "댓글_분석": []}'
    one = spark.createDataFrame([("clien", "7", reply % "negative")], "platform string, post_id string, reply string")
    assert {(r.platform, r.sentiment) for r in attach_sentiment(nested, one).collect()} == {("clien", "negative"), ("dcinside", None)}
    two = one.unionByName(spark.createDataFrame([("clien", "7", reply % "positive"), ("dcinside", "7", reply % "neutral")], one.schema))
    got = attach_sentiment(nested, two)
    assert sorted((r.platform, r.sentiment) for r in got.collect()) == [("clien", "positive"), ("dcinside", "neutral")]


def test_the_copy_with_the_greatest_figures_stays_and_comments_are_no_posts(spark):
    schema = "platform string, post_id string, checked_at string, view bigint, content string"
    rows = [("clien", "1", "t", 10, "old"), ("clien", "1", "t", 99, "new"), (None, "1", "t", None, "c1"), (None, "1", "t", None, "c1"), (None, "1", "t", None, "c2")]
    got = sorted(map(tuple, summary.dedupe(spark.createDataFrame(rows, schema)).select(F.coalesce("platform", F.lit("")), F.coalesce("view", F.lit(0)), "content").collect()))
    assert got == [("", 0, "c1"), ("", 0, "c1"), ("", 0, "c2"), ("clien", 99, "new")]


def test_backfill_counts_rows_without_a_time_in_the_batch_they_lie_in(spark, tmp_path):
    at = "2025-02-24T13:45:03"
    empty = spark.createDataFrame([], POSTS_SCHEMA)
    row = {name: F.lit(None).cast(POSTS_SCHEMA[name].dataType) for name in POSTS_SCHEMA.names}
    row |= {"content": F.lit("x"), "sentiment": F.lit("positive"), "view": F.lit(3).cast("bigint")}
    timed = row | {"checked_at": ntz("2025-02-24 13:45:03")}
    both = spark.range(1).select(*[c.alias(n) for n, c in row.items()]).unionByName(spark.range(2).select(*[c.alias(n) for n, c in timed.items()]))
    both.write.parquet(f"{tmp_path}/{batch_dir(at)}/a_posts.parquet")
    spark.range(1).select(*[c.alias(n) for n, c in row.items()]).write.parquet(f"{tmp_path}/{batch_dir('2025-02-24T13:50:03')}/a_posts.parquet")
    got = {str(r.checked_at): (r.total_posts_comments, r.total_views) for r in jobs.backfill(spark, str(tmp_path)).collect()}
    assert got == {"2025-02-24 13:45:03": (3, 9), "2025-02-24 13:50:00": (1, 3)}
    assert empty.count() == 0


def test_a_new_checkpoint_goes_on_from_the_latest_version(spark, tmp_path):
    def run(checkpoint, name, rows):
        hits(spark, rows).write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        source = spark.readStream.schema(HITS_SCHEMA).parquet(f"{tmp_path}/{name}")
        query = stream.stream_tracking(source, f"{tmp_path}/table", f"{tmp_path}/{checkpoint}")
        query.awaitTermination()
    run("c1", "first", [("a", 1000, 5, 1)])
    run("c2", "second", [("b", 990, 5, 2)])
    row = stream.read_tracking(spark, f"{tmp_path}/table").collect()
    assert len(row) == 1 and sorted(row[0].keywords) == ["a", "b"]


def test_rows_with_unreadable_counts_are_kept_apart(spark):
    typed = spark.createDataFrame([("/p", "1", 1, None, "2025"), ("/q", "2", 1, 5, "2025")], "url string, post_id string, comment_count int, view int, created_at string")
    assert [r.url for r in typed.dropna(subset=G.NEEDED).collect()] == ["/q"]


PATHS = [
    "file:/a/b/landing-1/2025-02-24/13/45/d0_all_posts.parquet/part-0.snappy.parquet", "s3a://b/l/2025-02-24/0/5/d_1.x_clien_comments.parquet/p",
    "file:///l/2025-02-24/13/45/d0_posts.parquet_posts.parquet/part", "file:/l/2025-02-24/13/45/broken.parquet/part-1", "file:/2025-02-24/13/45/d1_all_posts.parquet",
]


def test_folder_and_landing_of_a_file(column):
    folder = lambda c: F.regexp_extract(c, r"([^/]+/[^/]+/[^/]+)/[^/]+/[^/]+$", 1)
    name = lambda c: F.regexp_extract(c, r"/([^/]+)_(?:posts|comments)\.parquet(?:/[^/]*)?$", 1)
    assert column(landing.file_folder, PATHS) == column(folder, PATHS)
    assert column(landing.file_name, PATHS) == column(name, PATHS) == ["d0_all", "d_1.x_clien", "d0_posts.parquet", "", "d1_all"]
    assert column(landing.file_folder, PATHS[:1]) == ["2025-02-24/13/45"]


def test_backfill_finds_folders_without_a_pattern_per_row(spark, tmp_path, monkeypatch):
    plans, write = [], jobs.materialize
    monkeypatch.setattr(jobs, "materialize", lambda df, label: plans.append((label, df._jdf.queryExecution().optimizedPlan().toString())) or write(df, label))
    nested = spark.sql("select 'clien' platform, 't' title, '1' post_id, '/1' url, 'x' content, '5' view, timestamp_ntz '2025-01-01' created_at, '1' like, "
                       "cast(null as string) dislike, '0' comment_count, array('k') keywords, cast(null as string) sentiment, 'UNCHANGED' status, "
                       "cast(array() as array<struct<created_at:timestamp_ntz,content:string,like:string,dislike:string,sentiment:string>>) comment")
    landing.land_nested(nested, str(tmp_path / "l"), "2025-02-24T13:45:03", None, "d0")
    assert [(str(r.checked_at), r.total_posts_comments) for r in jobs.backfill(spark, str(tmp_path / "l")).collect()] == [("2025-02-24 13:45:03", 1)]
    assert "regexp" not in dict(plans)["batch-times"]
