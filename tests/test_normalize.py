"""Golden rows of landing, listing, sentiment and planning operators."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from townvoice.functions.times import crawl_window, ntz
from townvoice.operators import listing as L
from townvoice.operators import normalize as N
from townvoice.operators import planning as P
from townvoice.operators import sentiment as E
from townvoice.operators.summary import batch_summary
from townvoice.schemas import NESTED_SCHEMA
from townvoice.sources import landing, sinks
from townvoice.streaming.summary import landing_stream, stream_summary

AT = "2025-02-24T03:05:03"
T0 = datetime(2025, 2, 24, 3)


def nested(spark, *rows):
    base = dict(
        title="t", post_id="1", url="/1", content="c", view="10", created_at=T0, like="3", dislike=None, comment_count="2",
        keywords=[" 벤츠 ", "화재"], sentiment=None, status="UNCHANGED",
        comment=[(T0, "첫", "1", None, None), (None, "둘", "1,000", "x", None)],
    )
    rows = [{**base, **row} for row in rows or ({},)]
    return spark.createDataFrame([tuple(row[name] for name in NESTED_SCHEMA.names) for row in rows], NESTED_SCHEMA)


def test_landing_round_trip(spark, tmp_path):
    root = str(tmp_path)
    landing.land_nested(nested(spark, {}, {"post_id": "2", "comment": None, "keywords": None}), root, AT, "clien", "f0")
    assert (tmp_path / "2025-02-24" / "3" / "5" / "f0_clien_posts.parquet").is_dir()
    posts = {r.post_id: r for r in landing.scan_posts(spark, root, AT).collect()}
    assert posts["1"].keywords == "벤츠-화재" and posts["2"].keywords == "no_keyword"
    assert (posts["1"].view, posts["1"].like, posts["1"].dislike, posts["1"].platform) == (10, 3, None, "clien")
    assert posts["1"].checked_at == datetime(2025, 2, 24, 3, 5, 3)
    comments = {r.content: r for r in landing.scan_comments(spark, root, AT).collect()}
    assert (comments["첫"].like, comments["둘"].like, comments["둘"].dislike, comments["둘"].post_id) == (1, None, None, "1")
    merged = landing.scan_batch(spark, root, AT)
    assert merged.groupBy("kind").count().orderBy("kind").collect() == [("comment", 2), ("post", 2)]
    assert merged.filter("kind = 'comment' and title is null and view is null").count() == 2


def test_unreadable_count_fails_the_landing_or_is_split_off(spark, tmp_path):
    bad = nested(spark, {"view": "많음"}, {"post_id": "2"})
    with pytest.raises(Exception, match="not an integer"):
        landing.land_nested(bad, str(tmp_path), AT, "clien", "f0")
    good, rejected = N.split_strict(bad, "view", "comment_count")
    assert [r.post_id for r in good.collect()] == ["2"] and [r.post_id for r in rejected.collect()] == ["1"]


def test_missing_batch_and_bad_time_fail(spark, tmp_path):
    with pytest.raises(AnalysisException):
        landing.scan_batch(spark, str(tmp_path), AT)
    with pytest.raises(ValueError):
        landing.scan_batch(spark, str(tmp_path), "2025-02-24 03:05")


def test_corrupt_files_are_skipped_only_when_asked(spark, tmp_path):
    root = str(tmp_path)
    landing.land_nested(nested(spark), root, AT, "clien", "f0")
    (tmp_path / "2025-02-24" / "3" / "5" / "f1_clien_posts.parquet").write_bytes(b"not parquet at all")
    assert landing.scan_tolerant(spark, root, AT).count() == 3
    with pytest.raises(Exception):
        landing.scan_batch(spark, root, AT).collect()


def test_empty_batch_warns_and_goes_on(spark, tmp_path, capsys):
    landing.land_nested(nested(spark).limit(0), str(tmp_path), AT, "clien", "f0")
    df = landing.empty_batch_check(landing.scan_batch(spark, str(tmp_path), AT))
    assert "empty" in capsys.readouterr().err
    assert batch_summary(df, AT.replace("T", " ")).first().total_posts_comments == 0


def test_sinks(spark, tmp_path):
    root = str(tmp_path)
    landing.land_nested(nested(spark), root, AT, "clien", "f0")
    rows = landing.scan_posts(spark, root, AT)
    for _ in range(2):
        path = sinks.write_curated(rows, f"{root}/out", AT, files=2)
        summary_path = sinks.write_summary(batch_summary(rows, AT.replace("T", " ")), f"{root}/out", AT)
    assert path.endswith("/posts/2025-02-24/3/5/posts.parquet") and spark.read.parquet(path).count() == 1
    assert spark.read.parquet(summary_path).count() == 1
    for _ in range(2):
        sinks.load_append(rows, f"{root}/plain")
        sinks.load_append(rows, f"{root}/once", idempotent=True)
    assert spark.read.parquet(f"{root}/plain").count() == 2
    assert spark.read.parquet(f"{root}/once").count() == 1


def test_partitioned_layout_prunes(spark, tmp_path):
    rows = nested(spark, {}, {"post_id": "2"}).select("post_id", (F.lit("2025-02-24 03:05:03").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("post_id").cast("int"))).alias("checked_at"))
    landing.land_partitioned(rows, str(tmp_path / "p"))
    one = landing.scan_partitioned(spark, str(tmp_path / "p"), "2025-02-24T03:06:00")
    assert [r.post_id for r in one.collect()] == ["1"]
    assert landing.scan_partitioned(spark, str(tmp_path / "p")).count() == 2
    assert "PartitionFilters: [isnotnull" in one._jdf.queryExecution().executedPlan().toString()


def test_comment_rules(spark):
    rows = [("a", False), (f"x {N.DELETED_COMMENT}.", False), ("b", True), (None, None)]
    df = spark.createDataFrame(rows, "content string, blocked boolean").withColumns({"created_at": F.lit(1), "like": F.lit(2)})
    got = sorted((tuple(r) for r in N.drop_blocked_comments(df).collect()), key=str)
    assert got == sorted([("a", 1, 2), (None, None, None), (None, 1, 2)], key=str)
    counts = N.count_comments(nested(spark, {}, {"comment": None}, {"comment": []}))
    assert sorted(r.comment_count for r in counts.collect()) == [0, 0, 2]


def test_default_missing(spark):
    tracking = spark.createDataFrame(
        [("clien", "/1", 77, 8, T0)], "platform string, url string, view int, comment_count int, created_at timestamp_ntz"
    )
    details = spark.createDataFrame(
        [("clien", "/1", None, None, None, None, None, None, [(None, "x"), (T0 + timedelta(days=1), "y")])],
        "platform string, url string, title string, content string, view bigint, comment_count bigint, created_at timestamp_ntz, like bigint,"
        " comment array<struct<created_at: timestamp_ntz, content: string>>",
    )
    row = N.default_missing(details, tracking).first()
    assert (row.title, row.content, row.view, row.comment_count, row.created_at, row.like) == ("제목 없음", "본문 없음", 77, 8, T0, 0)
    assert [c.created_at for c in row.comment] == [T0, T0 + timedelta(days=1)]


def test_salt_and_category_filter(spark):
    df = spark.createDataFrame([("국산차게시판", "12"), ("news", "13"), ("자유게시판", "14"), ("유머게시판", "15"), ("내차사진", "16")], "category string, post_id string")
    assert sorted(r.post_id for r in N.salt_post_id(df).collect()) == ["b14", "j15", "l16", "m12"]
    assert sorted(r.post_id for r in L.category_filter(df).collect()) == ["12", "13", "14"]


def test_listing_window(spark):
    day = lambda d: datetime(2025, 2, d)
    rows = [("s", "k", 0, day(9)), ("s", "k", 1, day(5)), ("s", "k", 2, day(1)), ("s", "k", 3, day(4)), ("s", "other", 0, day(4)), ("s", "k", 4, None)]
    df = spark.createDataFrame(rows, "source string, keyword string, pos int, created_at timestamp_ntz")
    start, end = ntz("2025-02-04 00:00:00"), ntz("2025-02-05 00:00:00")
    take = sorted((r.keyword, r.pos) for r in L.listing_window(df, start, end).collect())
    assert take == [("k", 1), ("other", 0)]
    every = sorted((r.keyword, r.pos) for r in L.listing_window(df, start, end, "filter").collect())
    assert every == [("k", 1), ("k", 3), ("other", 0)]


def test_drop_repeated_pages(spark):
    pages = {1: [1, 2], 2: [3], 3: [3, 3], 4: [4], 5: [4]}
    rows = [("s", "k", page, post) for page, posts in pages.items() for post in posts] + [("s", "calm", 1, 1), ("s", "calm", 2, 2), ("s", "gap", 1, 1), ("s", "gap", 4, 1), ("s", "gap", 5, 2)]
    df = spark.createDataFrame(rows, "source string, keyword string, page int, post_id int")
    kept = {}
    for r in L.drop_repeated_pages(df).collect():
        kept.setdefault(r.keyword, set()).add(r.page)
    assert kept == {"k": {1, 2, 3}, "calm": {1, 2}, "gap": {1, 4}}


def test_attach_sentiment_by_position(spark):
    reply = lambda *labels: '{"게시글_감정": "negative", "댓글_분석": [%s]}' % ", ".join('{"감정": "%s"}' % x for x in labels)
    posts = nested(spark, {}, {"post_id": "2"}, {"post_id": "3"}, {"post_id": "4", "comment": None}, {"post_id": "5"})
    replies = spark.createDataFrame(
        [("1", reply("positive", "negative")), ("2", reply("positive")), ("3", reply("neutral", "neutral", "positive")), ("4", reply("positive"))],
        "post_id string, reply string",
    )
    got = {r.post_id: r for r in E.attach_sentiment(posts, replies, ("post_id",)).collect()}
    labels = {k: [c.sentiment for c in r.comment] if r.comment is not None else None for k, r in got.items()}
    assert labels == {"1": ["positive", "negative"], "2": ["positive", None], "3": ["neutral", "neutral"], "4": None, "5": [None, None]}
    assert {k: r.sentiment for k, r in got.items()} == {"1": "negative", "2": "negative", "3": "negative", "4": "negative", "5": None}
    assert [c.content for c in got["2"].comment] == ["첫", "둘"]


def backlog(spark, *counts):
    return spark.createDataFrame(list(zip(["a", "b", "c"], counts)), "platform string, backlog bigint")


FUNCTIONS = [("a fn", "a"), ("clien_fn", "b"), ("c_fn", "c")]


def calls(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.function_name, []).append((r.func_id, r.filler))
    return {k: sorted(v) for k, v in out.items()}


def test_detail_plan_in_blocks(spark, monkeypatch):
    whole = calls(P.detail_plan(backlog(spark, 200, 1, 500), FUNCTIONS, 40, "2025-02-24 00:00:00"))
    monkeypatch.setattr(P, "BLOCK", 2)
    assert calls(P.detail_plan(backlog(spark, 200, 1, 500), FUNCTIONS, 40, "2025-02-24 00:00:00")) == whole


def test_detail_plan(spark):
    plan = calls(P.detail_plan(backlog(spark, 0, 41, 40), FUNCTIONS, 40, "2025-02-24 00:00:00"))
    assert plan == {"clien_fn": [(i, False) for i in range(4)], "c_fn": [(0, False)]}
    df = P.detail_plan(backlog(spark, 200, 1, 0), FUNCTIONS, 40, "2025-02-24 00:00:00")
    assert calls(df) == {"a fn": [(i, False) for i in range(5)], "clien_fn": [(0, False), (1, False), (2, False), (3, True), (4, True)]}
    tasks = [r.task_id for r in df.orderBy("func_id", "source_pos").collect()]
    assert tasks[:2] == ["invoke_lambda_a_fn0", "invoke_lambda_clien_fn0"] and tasks[-1] == "invoke_lambda_clien_fn_all"
    plain = calls(P.detail_plan(backlog(spark, 200, 1, 0), FUNCTIONS, 40, "2025-02-24 00:00:00", flagged=None))
    assert plain == {"a fn": [(i, False) for i in range(5)], "clien_fn": [(0, False)]}
    assert P.detail_plan(backlog(spark, 0, 0, 0), FUNCTIONS, 40, "2025-02-24 00:00:00").count() == 0


def test_shards_cover_all_pending_rows(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise("cold").alias("platform"),
        F.concat(F.lit("/"), F.col("id").cast("string")).alias("url"),
        F.when(F.col("id") % 5 == 0, "UNCHANGED").otherwise("CHANGED").alias("status"),
    )
    shards = P.assign_shards(rows, 40)
    assert shards.count() == shards.select("platform", "url").distinct().count() == 800
    sizes = {(r.platform, r.shard): r["count"] for r in shards.groupBy("platform", "shard").count().collect()}
    assert max(sizes.values()) == 40
    for name in ("hot", "cold"):
        own = [n for (platform, _), n in sizes.items() if platform == name]
        assert sorted(own)[1:] == [40] * (len(own) - 1)


def test_backlog_counts(spark):
    rows = spark.createDataFrame([("a", "CHANGED"), ("a", "FAILED"), ("a", "BANNED"), ("a", "UNCHANGED")], "platform string, status string")
    assert dict(P.backlog_counts(rows, ["a", "b"]).collect()) == {"a": 2, "b": 0}
    assert dict(P.backlog_counts(rows, ["a", "b"], "older").collect()) == {"a": 3, "b": 0}


def test_search_plan(spark):
    keywords = spark.createDataFrame([("벤츠",), ("배터리",)], "keyword string")
    window = lambda: crawl_window(ntz("2025-02-24 01:02:03"))
    def dated(mode):
        rows = P.search_plan(keywords, ["clien fn", "dc_fn"], window(), mode).collect()
        assert len(rows) == 6
        return sorted((r.function_name, r.extra) for r in rows if r.start_date is not None and r.keyword == "벤츠")

    assert dated("extra") == [("clien fn", True)]
    assert dated("base") == [("clien fn", False), ("dc_fn", False)]
    assert dated("all") == [("clien fn", False), ("clien fn", True), ("dc_fn", False)]
    ids = {r.task_id for r in P.search_plan(keywords, ["clien fn"], window()).collect()}
    assert ids == {"invoke_lambda_clien_fn_벤츠", "invoke_lambda_clien_fn_배터리", "invoke_lambda_clien_fn_all"}


def test_keyword_lookup(spark):
    sets = spark.createDataFrame([("benz_battery_fire", ["벤츠", "배터리", "화재"])], "name string, keywords array<string>")
    assert [r.keyword for r in P.keyword_lookup(sets, "benz_battery_fire").collect()] == ["벤츠", "배터리", "화재"]
    assert P.keyword_lookup(sets, "nothing").count() == 0


def test_run_log(spark):
    runs = spark.createDataFrame([(datetime(2025, 2, 24, 13, 45, 3), "no_keyword", "clien", "f7")], "checked_at timestamp_ntz, keywords_str string, platform string, id string")
    row = P.run_log(runs, "bucket", ntz("2025-02-24 14:00:00")).first()
    assert row.posts_s3_path == "s3://bucket/2025-02-24/13/45/no_keyword/clien_posts.parquet"
    assert row.comments_s3_path == "s3://bucket/2025-02-24/13/45/no_keyword/clien_comments.parquet"
    assert P.run_log(runs, "bucket", ntz("2025-02-24 14:00:00"), "actual").first().posts_s3_path == "s3://bucket/2025-02-24/13/45/f7_clien_posts.parquet"


def test_stream_sees_files_in_any_order_and_drops_late_rows(spark, tmp_path):
    """Windows in append mode equal the batch result, whatever the order of the files."""
    def land(at, n, name):
        rows = nested(spark, *[{"post_id": str(i), "content": "화재"} for i in range(n)])
        landing.land_nested(rows, str(tmp_path / "in"), at, "clien", name)

    def run():
        summary = stream_summary(landing_stream(spark, str(tmp_path / "in"), glob="*.parquet"), lateness="10 minutes")
        query = (
            summary.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return {str(r.period): (r.total_posts_comments, r.fire_total_count) for r in spark.read.schema(summary.schema).parquet(str(tmp_path / "out")).collect()}

    land("2025-02-24T00:05:03", 2, "b")
    land("2025-02-24T00:00:03", 1, "a")  # older, arrives later
    run()
    land("2025-02-24T00:30:03", 1, "c")
    run()
    assert run() == {"2025-02-24 00:00:00": (3, 1), "2025-02-24 00:05:00": (6, 2)}
    land("2025-02-24T00:00:03", 5, "late")
    land("2025-02-24T01:00:03", 1, "d")
    assert run()["2025-02-24 00:00:00"] == (3, 1)


def test_jobs_end_to_end(spark, tmp_path):
    from townvoice import jobs

    landed, output, warehouse = (str(tmp_path / name) for name in ("landing", "output", "warehouse"))
    for minute, n in ((5, 1), (10, 3)):
        at = f"2025-02-24T03:{minute:02d}:03"
        landing.land_nested(nested(spark, *[{"post_id": str(i), "content": "현대 화재"} for i in range(n)]), landed, at, "clien", "f0")
        jobs.main(["transform", "--checked_at", at, "--landing", landed, "--output", output])
        jobs.main(["load", "--checked_at", at, "--output", output, "--warehouse", warehouse])
    stored = spark.read.parquet(f"{warehouse}/summary").orderBy("checked_at")
    assert [(r.total_posts_comments, r.fire_total_count, r.hyundai_total_count) for r in stored.collect()] == [(3, 1, 1), (9, 3, 3)]
    assert spark.read.parquet(f"{warehouse}/post").count() == 12
    again = jobs.backfill(spark, landed).orderBy("checked_at")
    assert again.collect() == stored.drop("batch_date").collect()
    with pytest.raises(SystemExit):
        jobs.main(["transform", "--checked_at", "2025-02-24 03:05", "--landing", landed, "--output", output])
    with pytest.raises(SystemExit):
        jobs.main(["load"])
