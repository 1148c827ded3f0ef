"""One key with most of the rows: partitions are split, results stay whole."""

from __future__ import annotations

import time
from contextlib import contextmanager
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from townvoice.functions.times import ntz
from townvoice.operators import listing as L
from townvoice.operators import normalize as N
from townvoice.operators import tracking as T
from townvoice.operators.fold import HIT, OUTCOME_SCHEMA, PACKED, Run, fold_ranges
from townvoice.schemas import HITS_SCHEMA
from townvoice.session import materialize

ROWS = 120_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.shuffle.partitions": "12",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run(df):
    """Row count and the plan that was really executed."""
    out = df.select(F.xxhash64(*df.columns).alias("row")).agg(F.count(F.lit(1)).alias("n"), F.max("row"))
    n = out.collect()[0].n
    return n, out._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hits(spark):
    """Two thirds of the hits are about one URL, found under one keyword of one source."""
    key = F.col("id")
    hot = key % 3 < 2
    rows = spark.range(ROWS).select(
        F.lit("clien").alias("platform"),
        F.when(hot, F.lit("/hot")).otherwise(F.concat(F.lit("/"), (key % 5000).cast("string"))).alias("url"),
        F.when(hot, F.lit("k")).otherwise(F.concat(F.lit("k"), (key % 50).cast("string"))).alias("keyword"),
        F.lit("s").alias("source"),
        F.concat(F.lit("title "), F.sha2(key.cast("string"), 256)).alias("title"),
        F.when(hot, key).otherwise(key % 700).alias("pos"),
        (ntz("2025-01-01 00:00:00") + F.make_dt_interval(mins=(key / 100).cast("int"))).alias("created_at"),
    )
    return materialize(rows, "hits")


def state(spark, hits):
    rows = hits.select("platform", "url").distinct().select(
        "*", F.array(F.lit("k")).alias("keywords"), F.lit("CHANGED").alias("status"), F.lit(1).alias("comment_count"),
        ntz("2025-01-01 00:00:00").alias("created_at"), ntz("2025-01-01 00:00:00").alias("checked_at"), F.lit(2).alias("view"),
    )
    return materialize(rows, "state")  # as between jobs


def test_lookup_splits_a_hot_url(spark, hits):
    with settings(spark, SMALL):
        n, plan = run(T.tracking_lookup(hits, state(spark, hits)))
    assert n == ROWS and "skew=true" in plan


def test_defaults_split_a_hot_url(spark, hits):
    details = hits.select("platform", "url", "title", "created_at", *[F.lit(None).cast(t).alias(c) for c, t in (("content", "string"), ("view", "int"), ("comment_count", "int"), ("like", "bigint"))])
    with settings(spark, SMALL):
        n, plan = run(N.default_missing(details, state(spark, hits)))
    assert n == ROWS and "skew=true" in plan


def test_a_hot_listing_is_spread(spark, hits):
    start, end = ntz("2025-01-01 00:00:00"), ntz("2026-01-01 00:00:00")
    old = hits.withColumn("created_at", F.when(F.col("pos") >= 70_000, F.col("created_at") - F.expr("INTERVAL 400 DAYS")).otherwise(F.col("created_at")))
    with settings(spark, {**SMALL, "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        kept = L.listing_window(old, start, end)
        sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == hits.filter("pos < 70000").count()
    assert max(sizes) < 2.5 * sum(sizes) / 12


def test_a_hot_url_is_folded_in_many_ranges(spark):
    """The outcomes of a URL's ranges are few, however many hits it has."""
    n = 40_000
    rows = spark.range(n).select(
        F.lit("clien").alias("platform"), F.lit("/hot").alias("url"), F.lit("1").alias("post_id"), F.lit("CHANGED").alias("status"),
        F.pmod(F.xxhash64("id"), F.lit(50)).cast("int").alias("comment_count"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000)).cast("int").alias("view"),
        ntz("2025-01-01 00:00:00").alias("created_at"),
        (ntz("2025-01-01 00:00:00") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("checked_at"),
        F.lit("k").alias("keyword"), F.col("id").alias("seq"),
    )
    with settings(spark, {**SMALL, "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        got = T.tracking_upsert(None, rows.select(*HITS_SCHEMA.names)).collect()
        hits = rows.select(
            "platform", "url", F.col("checked_at").alias("at"), "seq", F.lit(2).alias("kind"), "status", "view", "comment_count",
            "created_at", "checked_at", F.lit(False).alias("blank"), "post_id", F.lit(None).cast("string").alias("words"),
        )
        outcomes = (
            hits.repartitionByRange(12, "url", "at").sortWithinPartitions("url", "at")
            .mapInPandas(fold_ranges(100, False), OUTCOME_SCHEMA).withColumn("range", F.spark_partition_id())
        )
        ranges, total = outcomes.agg(F.countDistinct("range"), F.count(F.lit(1))).first()
    assert ranges >= 10 and total <= 20 * ranges
    state = None
    for r in rows.orderBy("seq").select("view", "comment_count", "checked_at").collect():
        if state is None or state[0] - r.view > 100 or state[1] > r.comment_count:
            state = (r.view, r.comment_count, r.checked_at)
    assert [(r.view, r.comment_count, r.checked_at) for r in got] == [state]
    assert got[0].checked_at > datetime(2025, 1, 1)


@pytest.mark.parametrize("rule, drift", [("literal", -1), ("documented", 1), ("documented", -1)])
def test_slowly_drifting_views_are_folded_in_many_ranges(spark, rule, drift):
    """Almost every hit is a new extreme; some are reports of a failure, some have an empty keyword."""
    n = 24_000
    id_ = F.col("id")
    rows = spark.range(n).select(
        F.lit("clien").alias("platform"), F.lit("/hot").alias("url"), F.lit("1").alias("post_id"),
        F.when(id_ % 997 == 996, "FAILED").otherwise("CHANGED").alias("status"), F.lit(7).alias("comment_count"),
        (100_000 + drift * id_ + F.when(id_ % 2 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(5)))).cast("int").alias("view"),
        ntz("2025-01-01 00:00:00").alias("created_at"),
        (ntz("2025-01-01 00:00:00") + F.make_dt_interval(secs=id_.cast("decimal(18,6)"))).alias("checked_at"),
        F.when(id_ % 5000 == 4567, "").otherwise("k").alias("keyword"), id_.alias("seq"),
    )
    with settings(spark, {**SMALL, "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        got = T.tracking_upsert(None, rows.select(*HITS_SCHEMA.names), rule=rule).collect()
    state, blank = None, False
    for r in rows.orderBy("seq").collect():
        if state and r.status == "FAILED":
            state = (*state[:2], "FAILED", r.checked_at)
        elif state is None or (abs(state[0] - r.view) > 100 if rule == "documented" else state[0] - r.view > 100):
            state = (r.view, r.comment_count, r.status, r.checked_at)
            blank = blank or r.keyword == ""
    assert [(r.view, r.comment_count, r.status, r.checked_at) for r in got] == [state]
    assert set(got[0].keywords) == ({"k", ""} if blank else {"k"})


def test_hits_of_one_time_and_number_are_ordered_across_ranges(spark):
    """No number tells the hits of one run apart, and there are ranges enough to cut them."""
    n = 24_000
    rows = spark.range(n).select(
        F.lit("clien").alias("platform"), F.lit("/hot").alias("url"), F.lit("1").alias("post_id"), F.lit("CHANGED").alias("status"),
        F.lit(7).alias("comment_count"), F.col("id").cast("int").alias("view"), ntz("2025-01-01 00:00:00").alias("created_at"),
        ntz("2025-01-01 00:00:00").alias("checked_at"), F.lit("k").alias("keyword"), F.lit(None).cast("bigint").alias("seq"),
    )
    with settings(spark, {**SMALL, "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        got = T.tracking_upsert(None, rows.select(*HITS_SCHEMA.names), rule="documented").collect()
    # views ascend from 0, and each state is left at the first view more than 100 above it
    assert [r.view for r in got] == [(n - 1) // 101 * 101]


@pytest.mark.parametrize("documented, drift", [(False, -1), (True, 1)])
def test_time_per_hit_does_not_grow_with_a_range(documented, drift):
    def took(n):
        run, started = Run(("clien", "/hot"), 0, 100, documented), time.process_time()
        for i in range(n):
            run.add(HIT, "CHANGED", 500_000 + drift * i, 7, 0, i, False, (i, i))
        rows = list(run.outcomes())
        assert len(rows) == -(-n // PACKED) and max(len(row[10]) for row in rows) <= 101 * 2 + 1
        return time.process_time() - started

    assert took(200_000) < 10 * 5 * took(20_000)
