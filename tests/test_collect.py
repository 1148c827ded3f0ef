"""Search and detail jobs, landings that fail, the log and the ledger."""

from __future__ import annotations

import glob
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_normalize import AT, nested
from test_pages import bobae_row
from test_tracking import result
from test_tracking_table import some_state

from townvoice import collect, jobs
from townvoice.functions.times import ntz
from townvoice.sources import landing, ledger
from townvoice.sources import tracking_table as store

NOW = "2025-02-24T13:45:03"
PAGES = "platform string, keyword string, page int, html string"


def dc_row(number, day="24", comments="", views=5):
    return (f'<tr class="ub-content us-post" data-no="{number}"><td class="gall_tit ub-word"><a href="/v?no={number}">t</a>{comments}</td>'
            f'<td class="gall_date" title="2025-02-{day} 10:00:00">x</td><td class="gall_count">{views}</td></tr>')


def clien_row(number, day="24"):
    return (f'<div class="list_item symph_row jirum" data-board-sn="{number}"><a class="subject_fixed" href="/s/{number}">t</a>'
            f'<span class="hit">7</span><span class="timestamp">2025-02-{day} 01:02:03</span></div>')


def clien_page(*rows):
    return '<a class="board-nav-page active">1</a>' + "".join(rows)


def states(spark, table):
    return {r.url.rsplit("/", 1)[-1].replace("v?no=", ""): r for r in store.read_table(spark, table).collect()}


def test_search_folds_the_rows_of_all_listings(spark, tmp_path):
    table = f"{tmp_path}/t"
    pages = spark.createDataFrame([
        ("dcinside", "a", 1, dc_row(1) + dc_row(2, "20") + dc_row(3)),  # ends at the old row
        ("dcinside", "b", 1, dc_row(1) + dc_row(4)), ("dcinside", "b", 2, dc_row(5) + dc_row(6)),
        ("dcinside", "b", 3, dc_row(6) + dc_row(5)), ("dcinside", "b", 4, dc_row(7)),  # page 3 repeats page 2
        ("clien", "a", 1, clien_page(clien_row(11), clien_row(12, "xx"))), ("clien", "a", 2, clien_row(13)),  # page 2 is beyond the last
        ("bobaedream", "a", 1, '<div class="search_Community"><ul>' + bobae_row("국산차게시판", 21, "25. 02. 24") + bobae_row("내차사진", 22, "25. 02. 24") + "</ul></div>"),
        ("elsewhere", "a", 1, dc_row(99)), ("dcinside", "c", 1, None),
    ], PAGES)
    start, end = ntz("2025-02-23 00:00:00"), ntz("2025-02-25 00:00:00")
    touched = collect.search(spark, pages, table, NOW, start, end)
    got = states(spark, table)
    assert set(got) == {"1", "4", "5", "6", "11", "view?code=x&No=21"} and touched.count() == 6
    assert (got["1"].keywords, got["1"].view, got["1"].status, got["1"].checked_at) == (["a", "b"], 5, "CHANGED", datetime(2025, 2, 24, 13, 45, 3))
    assert (got["view?code=x&No=21"].view, got["view?code=x&No=21"].post_id) == (-999, "m21")
    assert [(r.platform, r.post_id) for r in collect.search_rejects(pages).collect()] == [("clien", "12")]
    collect.search(spark, pages.limit(0), table, NOW, start, end)  # nothing listed changes nothing
    assert {k: v for k, v in states(spark, table).items()} == got
    later = spark.createDataFrame([("clien", "z", 1, clien_page(clien_row(11)))], PAGES)
    collect.search(spark, later, table, "2025-02-24T14:00:00", start, end)
    assert states(spark, table)["11"].keywords == ["a", "z"]


DETAILS = "platform string, url string, html string"


def detail_table(spark, table):
    rows = [(p, u, ["k"], u, "CHANGED", 3, datetime(2025, 2, 1), datetime(2025, 2, 24), 40) for p, u in [
        ("dcinside", "d1"), ("dcinside", "d2"), ("dcinside", "d3"), ("clien", "c1"), ("clien", "c2"), ("bobaedream", "b1"), ("bobaedream", "b2")]]
    store.seed_table(spark.createDataFrame(rows, store.TRACKING_SCHEMA), table, buckets=4)


CLIEN = '<h3 class="post_subject"><span>t</span></h3><div class="post_article">x</div><a class="post_reply"><span>8</span></a>'
BOBAE = '<div class="writerProfile"><dl><dt title="t"></dt><span class="countGroup">조회 <em>1,234</em></span></dl></div><div class="bodyCont">x</div>'


def test_detail_claims_reads_labels_and_lands(spark, tmp_path):
    table, root, log = (f"{tmp_path}/{name}" for name in ("t", "landing", "log"))
    detail_table(spark, table)
    pages = spark.createDataFrame([
        ("dcinside", "d1", '<title>T</title><li class="ub-content"><div class="clear cmt_txtbox"><p class="usertxt ub-word">one</p></div></li>'),
        ("dcinside", "d2", None), ("clien", "c1", CLIEN), ("clien", "c2", "<p>nothing</p>"), ("bobaedream", "b1", BOBAE), ("clien", "other", CLIEN)], DETAILS)
    replies = spark.createDataFrame(
        [("dcinside", "d1", '{"게시글_감정": "negative", "댓글_분석": [{"내용": "one", "감정": "positive"}]}')], "platform string, post_id string, reply string")
    outcomes = collect.detail(spark, pages, table, root, NOW, "f0", replies, log=log, now=ntz("2025-02-24 14:00:00"))
    assert {r.url: r.outcome for r in outcomes.collect()} == {
        "d1": "read", "d2": "banned", "d3": "unseen", "c1": "read", "c2": "failed", "b1": "read", "b2": "unseen"}
    got = states(spark, table)
    assert {u: r.status for u, r in got.items()} == {
        "d1": "UNCHANGED", "d2": "BANNED", "d3": "CHANGED", "c1": "UNCHANGED", "c2": "FAILED", "b1": "UNCHANGED", "b2": "CHANGED"}
    assert (got["b1"].view, got["c1"].comment_count, got["d1"].view, got["d1"].comment_count) == (1234, 8, 40, 3)
    posts = {r.url: r for r in landing.scan_posts(spark, root, NOW).collect()}
    assert set(posts) == {"d1", "c1", "b1"} and posts["d1"].sentiment == "negative" and posts["c1"].sentiment is None
    assert (posts["d1"].title, posts["d1"].content, posts["d1"].keywords, posts["b1"].like) == ("T", "본문 없음", "k", -999)
    assert [(r.platform, r.content, r.sentiment) for r in landing.scan_comments(spark, root, NOW).collect()] == [("dcinside", "one", "positive")]
    rows = spark.read.parquet(log).collect()
    assert sorted(r.platform for r in rows) == ["bobaedream", "clien", "dcinside"] and {r.checked_at for r in rows} == {datetime(2025, 2, 24, 13, 45, 3)}


def broken(df):
    """Comments that cannot be written; the posts are written first."""
    return df.withColumn("comment", F.transform("comment", lambda c: c.withField("content", F.raise_error(F.lit("disk full")).cast("string"))))


def test_a_landing_without_its_comments_is_not_seen_and_gives_its_urls_back(spark, tmp_path):
    table, root, log = (f"{tmp_path}/{name}" for name in ("t", "landing", "log"))
    claimed = [(p, u, ["k"], u, "UNCHANGED", 3, datetime(2025, 2, 1), datetime(2025, 2, 24), 40) for p, u in [("bobaedream", "/1"), ("dcinside", "/1"), ("clien", "/1"), ("clien", "/9")]]
    store.seed_table(spark.createDataFrame(claimed, store.TRACKING_SCHEMA), table, buckets=2)
    rows = nested(spark)
    for site in ("bobaedream", "dcinside", "clien"):
        with pytest.raises(Exception, match="disk full"):
            collect.land_batch(spark, broken(rows), root, AT, site, "f0", table, log)
    assert len(glob.glob(f"{root}/*/*/*/f0_*_posts.parquet")) == 3  # written, but not committed
    assert landing.scan_batch(spark, root, AT).count() == landing.scan_posts(spark, root, AT).count() == 0
    assert not glob.glob(log) and jobs.backfill(spark, root).collect() == []
    got = {(r.platform, r.url): r.status for r in store.read_table(spark, table).collect()}
    assert got == {("bobaedream", "/1"): "CHANGED", ("dcinside", "/1"): "FAILED", ("clien", "/1"): "CHANGED", ("clien", "/9"): "UNCHANGED"}
    assert collect.recover(spark, root, AT, table) == []  # given back once
    for _ in range(2):
        collect.land_batch(spark, rows, root, AT, "dcinside", "f0", table, log)
    assert landing.scan_batch(spark, root, AT).groupBy("platform", "kind").count().count() == 2
    assert spark.read.parquet(log).count() == 1
    # a landing that comes again and fails hides what it is replacing
    with pytest.raises(Exception, match="disk full"):
        collect.land_batch(spark, broken(rows), root, AT, "dcinside", "f0", table, log)
    assert landing.scan_batch(spark, root, AT).count() == 0


def test_a_crashed_landing_is_recovered_once(spark, tmp_path):
    table, root = f"{tmp_path}/t", f"{tmp_path}/landing"
    state = some_state(spark, 4, lambda i: "UNCHANGED").withColumn("platform", F.lit("clien"))
    store.seed_table(state, table, buckets=2)
    with pytest.raises(Exception, match="disk full"):  # nobody there to give the URLs back
        landing.land_nested(broken(nested(spark, {"url": "/2"}, {"url": "/3"})), root, AT, "clien", "f0")
    assert collect.recover(spark, root, AT, table) == ["f0_clien"] and collect.recover(spark, root, AT, table) == []
    assert {k[1]: v[4] for k, v in result(store.read_table(spark, table)).items()} == {"/0": "UNCHANGED", "/1": "UNCHANGED", "/2": "CHANGED", "/3": "CHANGED"}


def test_ledger_names_files_that_gave_no_rows(spark, tmp_path):
    root, folder = str(tmp_path), tmp_path / "2025-02-24" / "3" / "5"
    landing.land_nested(nested(spark).coalesce(1), root, AT, "clien", "f0")
    landing.land_nested(nested(spark).limit(0), root, AT, "clien", "f1")
    (folder / "f2_clien_posts.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception, match="disk full"):
        landing.land_nested(broken(nested(spark).coalesce(1)), root, AT, "dcinside", "f3")
    whole = glob.glob(f"{folder}/f0_clien_posts.parquet/part-*")[0]
    shutil.copy(whole, f"{folder}/f4_clien_posts.parquet")  # of another tool: no journal names it
    found = {}
    for row in ledger.file_ledger(spark, str(folder)).collect():
        found.setdefault((row.name, row.outcome), []).append(row.rows)
    assert {k: sum(v) for k, v in found.items()} == {
        ("f0_clien", "read"): 3, ("f1_clien", "empty"): 0, ("f2_clien", "unreadable"): 0, ("f3_dcinside", "hidden"): 1, ("f4_clien", "read"): 1}
    assert {r.folder for r in ledger.file_ledger(spark, str(folder)).collect()} == {"2025-02-24/3/5"}
    assert landing.scan_tolerant(spark, root, AT).count() == 4


def test_backfill_has_a_row_for_a_batch_without_rows(spark, tmp_path):
    root, out = f"{tmp_path}/landing", f"{tmp_path}/out"
    empty = "2025-02-24T04:10:07"
    landing.land_nested(nested(spark), root, AT, "clien", "f0")
    landing.land_nested(nested(spark).limit(0), root, empty, "clien", "f0")
    _, path = jobs.transform_batch(spark, root, out, empty)
    want = spark.read.parquet(path).first()
    got = {str(r.checked_at): r for r in jobs.backfill(spark, root).collect()}
    assert set(got) == {"2025-02-24 03:05:03", "2025-02-24 04:10:07"} and got["2025-02-24 04:10:07"].asDict() == want.asDict()


def test_listing_pages_come_with_their_document_in_one_pass(spark, sf_dir):
    from townvoice.plans.collecting import listings

    pages = listings(spark, sf_dir)
    assert "Join" not in pages._jdf.queryExecution().optimizedPlan().toString()
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted((r.page_id, r.lang, r.source) for r in pages.select("page_id", "lang", "source").collect())
    assert got == sorted((r.doc_id, r.lang, r.source) for r in documents.select("doc_id", "lang", "source").collect())


def test_refused_pages_come_out_of_the_pass_that_reads_pages(spark, tmp_path):
    platforms = ["clien", "dcinside", "bobaedream", "elsewhere"]
    claimed = spark.createDataFrame([(p, u, u, ["k"], 1, 2) for p in platforms for u in "abc"],
                                    "platform string, url string, post_id string, keywords array<string>, view int, comment_count int").withColumn("created_at", ntz(NOW.replace("T", " ")))
    spark.createDataFrame([(p, u, None if u == "a" else "<p>") for p in platforms for u in "ab"], "platform string, url string, html string").write.parquet(f"{tmp_path}/pages")
    outcomes = collect.nested_details(claimed, spark.read.parquet(f"{tmp_path}/pages"))[1]
    plan = outcomes._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan
    found = {(r.platform, r.url): r.outcome for r in outcomes.collect()}
    assert len(found) == outcomes.count() == 11
    assert {p: found[p, "a"] for p in platforms} == dict.fromkeys(platforms, "banned")
    assert {p: found[p, "c"] for p in platforms} == dict.fromkeys(platforms, "unseen")
    assert [found.get((p, "b")) for p in platforms] == ["failed", "read", "failed", None]


def test_texts_of_posts_are_written_once_and_take_part_in_no_join(spark, tmp_path):
    time = ntz(NOW.replace("T", " "))
    claimed = spark.createDataFrame([("clien", "a", "1", ["k"], 5, 2), ("dcinside", "a", "1", ["k"], 6, 3), ("dcinside", "b", "2", ["k"], 7, 4)],
                                    "platform string, url string, post_id string, keywords array<string>, view int, comment_count int").withColumn("created_at", time)
    listed = '<title>T</title><li class="ub-content"><div class="clear cmt_txtbox"><p class="usertxt ub-word">one</p></div></li>'
    spark.createDataFrame([("clien", "a", CLIEN), ("dcinside", "a", listed), ("dcinside", "b", "<p>")], DETAILS).write.parquet(f"{tmp_path}/pages")
    labels = '{"게시글_감정": "negative", "댓글_분석": [{"내용": "one", "감정": "positive"}, {"내용": "two", "감정": "neutral"}]}'
    replies = spark.createDataFrame([("dcinside", "1", labels), ("dcinside", "9", labels)], "platform string, post_id string, reply string")
    posts = collect.nested_details(claimed, spark.read.parquet(f"{tmp_path}/pages"), replies)[0]
    assert "Join" not in posts._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.platform, r.url): (r.sentiment, r.view, r.comment_count, r.created_at.isoformat(), [(c.content, c.sentiment, c.created_at.isoformat()) for c in r.comment])
           for r in posts.collect()}
    assert got == {
        ("clien", "a"): (None, "5", "8", NOW, []), ("dcinside", "a"): ("negative", "6", "3", NOW, [("one", "positive", NOW)]),
        ("dcinside", "b"): (None, "7", "4", NOW, [])}
