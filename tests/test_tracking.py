"""Crawl state: golden rows, and the fold against a plain loop on skewed random hits."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from townvoice.functions.times import ntz
from townvoice.operators import tracking as T
from townvoice.schemas import HITS_SCHEMA, TRACKING_SCHEMA

T0 = datetime(2025, 2, 24)
HIT = HITS_SCHEMA.names


def hit(url="/a", post_id="1", status="CHANGED", comment_count=5, view=1000, minute=0, keyword="k", seq=0, **more):
    at = T0 + timedelta(minutes=minute)
    row = dict(
        platform="clien", url=url, post_id=post_id, status=status, comment_count=comment_count, view=view,
        created_at=T0, checked_at=at, keyword=keyword, seq=seq,
    )
    row.update(more)
    return row


def frame(spark, rows, schema=HITS_SCHEMA):
    return spark.createDataFrame([tuple(row[name] for name in schema.names) for row in rows], schema)


def plain_upsert(state, hits, threshold, documented):
    """One hit after the other, as the rules read."""
    table = {(row["platform"], row["url"]): dict(row, keywords=list(row["keywords"])) for row in state}
    for h in sorted(hits, key=lambda h: (h["checked_at"], h["seq"])):
        if h["url"] is None or h["checked_at"] is None or h["status"] is None:
            continue
        key = (h["platform"], h["url"])
        s = table.get(key)
        figures = ["comment_count", "view", "created_at", "keyword"]
        if s is None:
            if all(h[name] is not None for name in ["post_id", *figures]):
                table[key] = {name: h[name] for name in TRACKING_SCHEMA.names if name != "keywords"} | {"keywords": [h["keyword"]]}
            continue
        if h["status"] in ("FAILED", "BANNED"):
            s.update(status=h["status"], checked_at=h["checked_at"])
            continue
        if any(h[name] is None for name in figures):
            continue
        if documented:
            fires = abs(s["view"] - h["view"]) > threshold or s["comment_count"] != h["comment_count"]
        else:
            fires = s["view"] - h["view"] > threshold or s["comment_count"] > h["comment_count"]
        if fires or (h["keyword"] != "" and h["keyword"] not in s["keywords"]):
            s.update({name: h[name] for name in ("status", "comment_count", "view", "created_at", "checked_at")})
            if h["keyword"] not in s["keywords"]:
                s["keywords"].append(h["keyword"])
    return {key: tuple(tuple(row[n]) if n == "keywords" else row[n] for n in TRACKING_SCHEMA.names) for key, row in table.items()}


def result(df):
    return {(r.platform, r.url): tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect()}


def random_hits(rng, n, urls, minutes, holes, keywords, views, first_seq=0):
    rows = []
    for seq in range(first_seq, first_seq + n):
        row = hit(
            # The first URL has well over a third of all hits.
            url=f"/{0 if rng.random() < 0.6 else rng.randrange(urls)}",
            status=rng.choice(["CHANGED"] * 6 + ["UNCHANGED", "FAILED", "BANNED"]),
            comment_count=rng.randrange(8), view=rng.randrange(views), minute=rng.randrange(minutes),
            keyword=rng.choice(keywords), seq=seq, platform=rng.choice(["clien", "dcinside"]),
            created_at=T0 + timedelta(minutes=rng.randrange(500)),
        )
        if rng.random() < holes:
            row[rng.choice(["post_id", "status", "comment_count", "view", "created_at", "keyword"])] = None
        rows.append(row)
    return rows


@pytest.mark.parametrize("rule", ["literal", "documented"])
@pytest.mark.parametrize("seed, n, urls, views, threshold, holes, keywords", [
    (1, 900, 12, 1000, 100, 0.0, ["a", "b", ""]),
    (2, 900, 5, 300, 100, 0.3, ["a", "b", "", "c"]),
    (3, 700, 3, 5000, 0, 0.1, [""]),
    (4, 1200, 40, 120, 100, 0.5, ["a", ""]),
])
def test_upsert_equals_a_plain_loop(spark, rule, seed, n, urls, views, threshold, holes, keywords):
    rng = random.Random(seed)
    hits = random_hits(rng, n, urls, 400, holes, keywords, views)
    # Many small ranges, so that hot URLs are cut often.
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        expected = plain_upsert([], hits, threshold, rule == "documented")
        assert result(T.tracking_upsert(None, frame(spark, hits), threshold, rule)) == expected

        half = [h for h in hits if h["checked_at"] < T0 + timedelta(minutes=200)]
        rest = [h for h in hits if h["checked_at"] >= T0 + timedelta(minutes=200)]
        state = [dict(zip(TRACKING_SCHEMA.names, row)) for row in plain_upsert([], half, threshold, rule == "documented").values()]
        again = T.tracking_upsert(frame(spark, state, TRACKING_SCHEMA), frame(spark, rest), threshold, rule)
        assert result(again) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("rule", ["literal", "documented"])
def test_urls_stay_whole_where_none_is_hot(spark, rule):
    """Ranges are found by a further pass over the hits; it is made only where a URL may fill one."""
    rng = random.Random(5)
    hits = [dict(h, url=f"/{n % 60}") for n, h in enumerate(random_hits(rng, 1500, 60, 400, 0.2, ["a", "b", "", "c"], 600))]
    hot = [dict(h, platform="clien", url="/hot") for h in random_hits(rng, 1500, 2, 400, 0.2, ["a", ""], 600, first_seq=len(hits))]
    for rows, ranged in ((hits, False), (hits + hot, True)):
        got = T.tracking_upsert(None, frame(spark, rows), rule=rule)
        assert ("rangepartitioning" in got._jdf.queryExecution().executedPlan().toString()) == ranged
        assert result(got) == plain_upsert([], rows, 100, rule == "documented")
        state = [dict(zip(TRACKING_SCHEMA.names, row)) for row in plain_upsert([], rows[::2], 100, rule == "documented").values()]
        again = T.tracking_upsert(frame(spark, state, TRACKING_SCHEMA), frame(spark, rows[1::2]), rule=rule)
        assert result(again) == plain_upsert(state, rows[1::2], 100, rule == "documented")


def upsert_one(spark, *hits, **options):
    rows = result(T.tracking_upsert(None, frame(spark, hits), **options))
    return {url: dict(zip(TRACKING_SCHEMA.names, row)) for (_, url), row in rows.items()}


def test_upsert_golden_rows(spark):
    out = upsert_one(
        spark,
        hit(url="/new"),
        hit(url="/no-post-id", post_id=None),
        hit(url="/rise"), hit(url="/rise", view=5000, minute=1),
        hit(url="/fall-100"), hit(url="/fall-100", view=900, minute=1),
        hit(url="/fall-101"), hit(url="/fall-101", view=899, minute=1),
        hit(url="/sentinel"), hit(url="/sentinel", view=-999, comment_count=-999, minute=1),
        hit(url="/keyword"), hit(url="/keyword", keyword="other", minute=1),
        hit(url="/empty"), hit(url="/empty", keyword="", minute=1),
        hit(url="/empty-fires"), hit(url="/empty-fires", keyword="", comment_count=4, minute=1),
        hit(url="/failed"), hit(url="/failed", status="FAILED", view=1, minute=1),
        hit(url="/order", seq=1), hit(url="/order", view=500, seq=3), hit(url="/order", view=450, seq=2),
    )
    assert "/no-post-id" not in out
    assert out["/new"]["keywords"] == ("k",) and out["/new"]["checked_at"] == T0
    assert out["/rise"]["view"] == 1000 and out["/rise"]["checked_at"] == T0
    assert out["/fall-100"]["view"] == 1000
    assert out["/fall-101"]["view"] == 899 and out["/fall-101"]["checked_at"] == T0 + timedelta(minutes=1)
    assert out["/sentinel"]["view"] == -999
    assert out["/keyword"]["keywords"] == ("k", "other")
    assert out["/empty"]["keywords"] == ("k",) and out["/empty"]["checked_at"] == T0
    assert out["/empty-fires"]["keywords"] == ("k", "")
    assert out["/failed"]["status"] == "FAILED" and out["/failed"]["view"] == 1000
    assert out["/order"]["view"] == 450


def test_documented_rule_sees_growth(spark):
    out = upsert_one(spark, hit(), hit(view=1101, minute=1), rule="documented")
    assert out["/a"]["view"] == 1101


def state(url="/a", status="CHANGED", checked_at=T0, **more):
    row = dict(
        platform="clien", url=url, keywords=["k"], post_id="1", status=status, comment_count=5,
        created_at=T0, checked_at=checked_at, view=10,
    )
    row.update(more)
    return row


def test_claim(spark):
    now = "2025-02-24 12:00:00"
    noon = datetime(2025, 2, 24, 12)
    rows = [
        state("/changed"), state("/failed", "FAILED"), state("/done", "UNCHANGED"),
        state("/banned59", "BANNED", noon - timedelta(minutes=59)),
        state("/banned60", "BANNED", noon - timedelta(minutes=60)),
        state("/banned61", "BANNED", noon - timedelta(minutes=61)),
    ]
    tracking = frame(spark, rows, TRACKING_SCHEMA)
    claimed, after = T.claim_pending(tracking, ntz(now))
    assert {r.url: r.status for r in claimed.collect()} == {"/changed": "CHANGED", "/banned61": "CHANGED"}
    assert {r.url: r.status for r in after.collect()} == {
        "/changed": "UNCHANGED", "/failed": "FAILED", "/done": "UNCHANGED",
        "/banned59": "BANNED", "/banned60": "BANNED", "/banned61": "UNCHANGED",
    }
    again, _ = T.claim_pending(after, ntz(now))
    assert again.count() == 0
    one, after = T.claim_pending(tracking, ntz(now), limit=1)
    assert [r.url for r in one.collect()] == ["/changed"]
    assert after.filter(F.col("url") == "/banned61").first().status == "BANNED"
    failed, _ = T.claim_pending(tracking, ntz(now), reclaim_failed=True)
    assert {r.url for r in failed.collect()} == {"/changed", "/banned61", "/failed"}


@pytest.mark.parametrize("limit", [0, 1, 37, 250, 400])
def test_first_rows_with_ties(spark, limit):
    """Most rows have one time; the number taken may span ranges, end in one, or exceed all."""
    rows = spark.range(300).selectExpr(
        "if(id % 5 = 0, null, timestamp_ntz '2025-02-24 00:00:00') as checked_at", "'clien' as platform", "concat('/', id) as url")
    order = ["checked_at", "platform", "url"]
    want = [r.url for r in rows.orderBy(*order).limit(limit).collect()]
    got = [r.url for r in T.first_rows(rows.repartition(7), order, limit).collect()]
    assert sorted(got) == sorted(want) and len(got) == min(limit, 300)


def test_status_transition_keeps_time_without_one(spark):
    tracking = frame(spark, [state("/a"), state("/b")], TRACKING_SCHEMA)
    later = T0 + timedelta(hours=1)
    changes = spark.createDataFrame(
        [("clien", "/a", "FAILED", later, 1), ("clien", "/a", "BANNED", None, 2)],
        "platform string, url string, status string, checked_at timestamp_ntz, seq bigint",
    )
    out = {r.url: r for r in T.status_transition(tracking, changes).collect()}
    assert (out["/a"].status, out["/a"].checked_at) == ("BANNED", later)
    assert (out["/b"].status, out["/b"].checked_at) == ("CHANGED", T0)


def test_detail_refresh_needs_all_figures(spark):
    tracking = frame(spark, [state("/a"), state("/b")], TRACKING_SCHEMA)
    details = spark.createDataFrame(
        [("clien", "/a", 9, 99, T0, 1), ("clien", "/a", 7, None, T0, 2), ("clien", "/b", 7, None, T0, 3)],
        "platform string, url string, comment_count int, view int, created_at timestamp_ntz, seq bigint",
    )
    out = {r.url: r for r in T.detail_refresh(tracking, details).collect()}
    assert (out["/a"].status, out["/a"].comment_count, out["/a"].view) == ("UNCHANGED", 9, 99)
    assert (out["/b"].status, out["/b"].view) == ("CHANGED", 10)


def test_rollback(spark):
    tracking = frame(spark, [state("/a", "UNCHANGED"), state("/b", "UNCHANGED")], TRACKING_SCHEMA)
    urls = tracking.filter("url = '/a'").unionByName(tracking.filter("url = '/a'"))
    out = {r.url: r.status for r in T.failed_write_rollback(tracking, urls, "CHANGED").collect()}
    assert out == {"/a": "CHANGED", "/b": "UNCHANGED"}


def test_urls_without_hits_keep_their_row(spark):
    tracking = frame(spark, [state("/quiet", keywords=["x", "x"]), state("/hit"), state("/banned")], TRACKING_SCHEMA)
    hits = frame(spark, [
        hit(url="/hit", view=5, keyword="new", minute=1), hit(url="/new", minute=1),
        hit(url="/banned", status="BANNED", post_id=None, view=None, comment_count=None, keyword=None, created_at=None, minute=2),
        hit(url="/unknown", post_id=None, minute=1),
    ])
    out = {url: dict(zip(TRACKING_SCHEMA.names, row)) for (_, url), row in result(T.tracking_upsert(tracking, hits)).items()}
    assert set(out) == {"/quiet", "/hit", "/new", "/banned"}
    assert out["/quiet"]["keywords"] == ("x",) and out["/quiet"]["view"] == 10
    assert out["/hit"]["keywords"] == ("k", "new") and out["/hit"]["view"] == 5
    assert (out["/banned"]["status"], out["/banned"]["checked_at"], out["/banned"]["view"]) == ("BANNED", T0 + timedelta(minutes=2), 10)
