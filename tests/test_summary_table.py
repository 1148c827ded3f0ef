"""Summaries merged delivery by delivery, and terms packed or found by an automaton."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from test_tracking import frame, hit, plain_upsert, result

from townvoice.operators import fold, tracking
from townvoice.operators import summary as S
from townvoice.schemas import POSTS_SCHEMA
from townvoice.sources import summary_table as store

T0 = datetime(2025, 2, 24)
TERMS = [("brand", "현대", "hyundai"), ("issue", "화재", "fire")]


def rows(spark, *items):
    """(minute, view, content) as landing rows."""
    known = [dict(content=content, view=view, checked_at=None if minute is None else T0 + timedelta(minutes=minute), sentiment="positive") for minute, view, content in items]
    return spark.createDataFrame([tuple(row.get(name) for name in POSTS_SCHEMA.names) for row in known], POSTS_SCHEMA)


def shown(spark, path):
    return {str(r.period)[5:16]: (r.total_posts_comments, r.total_views, r.positive, r.hyundai_total_count, r.fire_total_count)
            for r in store.read_summary(spark, path, TERMS).collect()}


def test_deliveries_add_up_and_late_rows_are_kept_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "ANEW", 3)  # the journal is written anew within the test
    path = str(tmp_path / "t")
    deliver = lambda n, *items: store.merge_summary(spark, path, rows(spark, *items), TERMS, origin="o", batch=n)
    assert deliver(0, (0, 1, "현대"), (4, 2, "x"), (7, None, None), (None, 5, "no time")) == 0
    assert shown(spark, path) == {"02-24 00:00": (2, 3, 2, 1, 0), "02-24 00:05": (1, None, 1, 0, 0)}
    for _ in range(2):  # a delivery that comes again counts once
        assert deliver(1, (1, 10, "화재"), (21, 1, "현대 화재"), (1439, 1, "x")) == 0
    assert shown(spark, path)["02-24 00:00"] == (3, 13, 3, 1, 1)
    # the youngest row was of 23:59: periods that ended 10 minutes before it are closed
    assert deliver(2, (3, 1, "x"), (1422, 1, "x"), (1430, 4, "x"), (1441, 1, "x")) == 2
    assert deliver(3, (1435, 1, "x"), (1440, 1, "x")) == 0
    got = shown(spark, path)
    assert got["02-24 00:00"] == (3, 13, 3, 1, 1) and got["02-24 23:50"][:2] == (1, 4) and got["02-24 23:55"][:2] == (2, 2) and got["02-25 00:00"][:2] == (2, 2)
    assert "02-24 23:40" not in got
    total, late = store.late_rows(spark, path)
    assert total == 2 and sorted(r.checked_at.minute for r in late.collect()) == [3, 42]
    with pytest.raises(ValueError):
        deliver(1, (1, 1, "x"))


def test_an_empty_delivery_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert store.merge_summary(spark, path, spark.createDataFrame([], POSTS_SCHEMA), TERMS) == 0
    assert shown(spark, path) == {} and store.late_rows(spark, path)[0] == 0


def test_packed_flags_give_the_same_totals(spark):
    lexicon = [("c", term, f"n{i}") for i, term in enumerate(a + b for a in "abcdefghij" for b in "abcdefghijklmn")]  # 140 terms, 3 words
    r = random.Random(2)
    texts = [("".join(r.choice("abcdefghijklmn ") for _ in range(80)), i % 3) for i in range(60)] + [(None, 1), ("", 2)]
    df = spark.createDataFrame(texts, "content string, other int")
    packed = S.packed_flags(df, lexicon)
    assert packed.columns == ["content", "other", "_bits0", "_bits1", "_bits2"]
    want = S.keyword_flags(df, lexicon).drop("content").collect()
    assert sorted(S.unpacked_flags(packed.drop("content"), lexicon).collect()) == sorted(want)


def test_ten_thousand_terms_equal_contains(spark):
    r = random.Random(3)
    texts = ["".join(r.choice("abcdeé현") for _ in range(r.randrange(200))) for _ in range(80)] + [None, "", "abcabc"]
    terms = list({"".join(r.choice("abcdeé현") for _ in range(r.randrange(1, 9))) for _ in range(30_000)})[:9_990]
    lexicon = [("c", term, f"n{i}") for i, term in enumerate([*terms, "", "zz", "abc", "abc", "bca", "현", "é", "(a", ".", "a b"])]
    assert len(lexicon) == 10_000 > S.MANY_TERMS
    got = {r.name: r.total for r in S.keyword_long(spark.createDataFrame([(t,) for t in texts], "content string").repartition(3), lexicon).collect()}
    assert got == {name: sum(term in t for t in texts if t is not None) for _, term, name in lexicon}


@pytest.mark.parametrize("rule", ["literal", "documented"])
def test_long_chains_of_outcomes_equal_a_plain_loop(spark, rule, monkeypatch):
    """One URL of drifting views, cut into many ranges whose outcomes are walked through."""
    monkeypatch.setattr(tracking, "LONG", 2)
    monkeypatch.setattr(fold, "PACKED", 5)
    r = random.Random(8)
    hits = []
    for n in range(900):
        url = f"/{0 if r.random() < 0.8 else r.randrange(5)}"
        status = r.choice(["CHANGED"] * 12 + ["FAILED", "BANNED"])
        hits.append(hit(url=url, view=5000 - n + r.randrange(5), minute=n, seq=n, status=status, keyword=r.choice(["a", "a", "b", ""]), comment_count=50 + r.randrange(3)))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        final = tracking.final_state
        monkeypatch.setattr(tracking, "final_state", lambda outcomes, threshold, rule, most: final(outcomes, threshold, rule, long=2))
        got = result(tracking.tracking_upsert(None, frame(spark, hits), rule=rule))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == plain_upsert([], hits, 100, rule == "documented")


def test_bucketed_posts_and_replies_join_without_a_shuffle(spark, sf_dir):
    from townvoice.plans import columns

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = columns.attach_sentiment_bucketed(spark, sf_dir)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    assert sorted(map(str, got.collect())) == sorted(map(str, columns.attach_sentiment(spark, sf_dir).collect()))


def test_the_label_join_of_a_summary_moves_bits(spark, sf_dir):
    from townvoice.plans import summaries

    plan = summaries.batch_summary(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join LeftOuter"):].split("Relation [doc_id")[0]  # down to the scan of the texts
    assert "_bits0" in join and "fire_count" not in join
