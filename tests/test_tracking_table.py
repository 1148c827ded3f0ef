"""The stored tracking table: versions, folding, replay and claims against plain loops."""

from __future__ import annotations

import glob
import os
import random
from datetime import timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_tracking import T0, frame, hit, plain_upsert, random_hits, result

from townvoice.functions.times import ntz
from townvoice.operators import tracking as T
from townvoice.schemas import HITS_SCHEMA, TRACKING_SCHEMA
from townvoice.sources import tracking_table as S
from townvoice.streaming.tracking import read_tracking, stream_tracking

KEYS = "platform string, url string"


def some_state(spark, n, status=lambda i: ["CHANGED", "UNCHANGED", "FAILED", "BANNED"][i % 4]):
    rows = [("clien" if i % 2 else "dcinside", f"/{i}", ["k"], str(i), status(i), i % 7, T0, T0 + timedelta(minutes=i % 90), i) for i in range(n)]
    return spark.createDataFrame(rows, TRACKING_SCHEMA)


def size(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/part-*", recursive=True))


@pytest.fixture
def quick(monkeypatch):
    """Fold often, so that slots are used again within a test."""
    monkeypatch.setattr(S, "FOLD_EVERY", 2)
    monkeypatch.setattr(S, "CHANGE_SLOTS", 6)


def test_many_versions_equal_one_plain_loop(spark, tmp_path, quick):
    """Slots are used many times over; each version and the one before can be read."""
    rng, path, done = random.Random(4), f"{tmp_path}/t", []
    for n in range(6):
        rows = random_hits(rng, 25, 12, 60, 0.1, ["k", "l", ""], 900, first_seq=1000 * n)
        for row in rows:
            row["checked_at"] += timedelta(hours=n)
        before = plain_upsert([], done, 100, False)
        done += rows
        S.upsert_table(spark, path, frame(spark, rows), origin="o", batch=n, buckets=4)
        assert result(S.read_table(spark, path)) == plain_upsert([], done, 100, False), n
        if n > 4:
            assert result(S.read_table(spark, path, before=n + 1)) == before, n
    state = S.journal(spark, path)
    assert len(state.versions) <= S.CHANGE_SLOTS and all(len(bases) <= 2 for bases in state.bases.values())
    assert len(glob.glob(f"{path}/changes/*")) <= S.CHANGE_SLOTS


def test_a_replayed_batch_counts_once(spark, tmp_path, quick):
    path = f"{tmp_path}/t"
    batches = [[hit(view=1000 - 200 * n, minute=n, keyword=f"k{n}", seq=n)] for n in range(3)]
    for n, rows in enumerate(batches):
        for _ in range(2):  # also right after a fold
            S.upsert_table(spark, path, frame(spark, rows), origin="o", batch=n, buckets=2)
        assert result(S.read_table(spark, path)) == plain_upsert([], sum(batches[: n + 1], []), 100, False)
    with pytest.raises(ValueError, match="before later versions"):
        S.upsert_table(spark, path, frame(spark, batches[2]), origin="o", batch=1)
    S.upsert_table(spark, path, frame(spark, batches[0]), origin="other", batch=0)  # another checkpoint goes on
    assert S.journal(spark, path).latest() == 4


def test_rows_without_a_journal_entry_are_not_seen(spark, tmp_path):
    path = f"{tmp_path}/t"
    S.seed_table(some_state(spark, 20), path, buckets=4)
    want = result(S.read_table(spark, path))

    def fails(state):
        return state.withColumn("view", F.raise_error(F.lit("lost")).cast("int"))

    with pytest.raises(Exception, match="lost"):
        S.change_table(spark, path, some_state(spark, 20), fails)
    assert result(S.read_table(spark, path)) == want and S.journal(spark, path).latest() == 1


def test_bytes_follow_the_hits(spark, tmp_path):
    path = f"{tmp_path}/t"
    S.seed_table(some_state(spark, 20_000, lambda i: "UNCHANGED"), path, buckets=64)
    whole = size(f"{path}/base")
    for n in range(4):
        S.upsert_table(spark, path, frame(spark, [hit(url=f"/{2 * i + 1}", platform="clien", view=0, keyword="new", minute=n, seq=i) for i in range(20)]))
    assert size(f"{path}/base") == whole
    assert size(f"{path}/changes") < whole / 5
    S.fold_table(spark, path)
    assert size(f"{path}/base") < 1.5 * whole  # only the touched buckets again
    assert S.read_table(spark, path).filter("array_contains(keywords, 'new')").count() == 20


def test_hits_that_lie_in_one_file_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "ROW_GROUP", 64 << 10, raising=False)
    path, rows = f"{tmp_path}/t", random_hits(random.Random(2), 12_000, 40, 400, 0.1, ["k", "l", ""], 900)
    S.upsert_table(spark, path, frame(spark, rows).coalesce(1), buckets=4)
    files = glob.glob(f"{path}/scratch/*-hits/part-*.parquet")
    assert len(files) == 1 and pq.ParquetFile(files[0]).num_row_groups > 1
    assert result(S.read_table(spark, path)) == plain_upsert([], rows, 100, False)


def test_claims_read_waiting_rows_and_equal_the_plain_operator(spark, tmp_path, quick):
    path, state = f"{tmp_path}/t", some_state(spark, 400)
    S.seed_table(state, path, buckets=4)
    seen = set()
    for _ in range(4):
        now = ntz("2025-02-24 02:00:00")
        claimed, after = T.claim_pending(S.read_table(spark, path), now, limit=23)
        want, left = result(claimed), result(after)
        got = result(S.claim_table(spark, path, now, limit=23))
        assert got == want and result(S.read_table(spark, path)) == left
        assert not seen & got.keys()
        seen |= got.keys()
    pending = S.read_table(spark, path, pending=True)
    assert all("/pending=1/" in f or "/changes/" in f for f in pending.inputFiles())
    assert result(pending) == result(S.read_table(spark, path).filter(S.waiting()))
    assert S.claim_table(spark, f"{tmp_path}/none", ntz("2025-02-24 02:00:00")).collect() == []


def test_transitions_details_and_rollback_equal_the_plain_operators(spark, tmp_path, quick):
    path, state = f"{tmp_path}/t", some_state(spark, 60)
    S.seed_table(state, path, buckets=8)
    changes = spark.createDataFrame(
        [("clien", "/1", "FAILED", T0, 1), ("clien", "/1", "BANNED", None, 2), ("dcinside", "/4", "CHANGED", None, 3), ("clien", "/none", "FAILED", T0, 4)],
        f"{KEYS}, status string, checked_at timestamp_ntz, seq long")
    details = spark.createDataFrame([("clien", "/3", 9, 8, T0, 1), ("clien", "/5", None, 8, T0, 1)], f"{KEYS}, comment_count int, view int, created_at timestamp_ntz, seq long")
    urls = spark.createDataFrame([("dcinside", "/8"), ("dcinside", "/8"), (None, "/8")], KEYS)
    want = T.failed_write_rollback(T.detail_refresh(T.status_transition(state, changes), details), urls, "FAILED")
    S.transition_table(spark, path, changes)
    S.refresh_table(spark, path, details)
    S.rollback_table(spark, path, urls, "FAILED")
    assert result(S.read_table(spark, path)) == result(want)


def test_a_seed_replaces_the_table_and_may_change_its_buckets(spark, tmp_path):
    path = f"{tmp_path}/t"
    S.seed_table(some_state(spark, 30), path, buckets=4)
    S.upsert_table(spark, path, frame(spark, [hit(url="/new")]))
    S.seed_table(some_state(spark, 10), path, buckets=7)
    assert result(S.read_table(spark, path)) == result(some_state(spark, 10)) and S.journal(spark, path).buckets == 7
    assert S.read_table(spark, f"{tmp_path}/none") is None


def test_empty_batches_are_versions_too(spark, tmp_path):
    path = f"{tmp_path}/t"
    S.upsert_table(spark, path, frame(spark, []), origin="o", batch=0)
    assert S.read_table(spark, path).collect() == []
    S.upsert_table(spark, path, frame(spark, [hit()]), origin="o", batch=1)
    S.upsert_table(spark, path, frame(spark, []), origin="o", batch=2)
    assert S.read_table(spark, path).count() == 1


def test_stream_applies_every_batch_once(spark, tmp_path):
    root, expected = str(tmp_path), []
    for n in range(3):
        rows = [hit(url="/a", view=1000 - 200 * n, minute=n, keyword=f"k{n}", seq=n)]
        expected += rows
        frame(spark, rows).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(HITS_SCHEMA).parquet(f"{root}/in")
        stream_tracking(stream, f"{root}/out", f"{root}/check", buckets=4).awaitTermination()
    assert sorted(batch for _, batch, _ in S.journal(spark, f"{root}/out").versions.values()) == [0, 1, 2]
    assert result(read_tracking(spark, f"{root}/out")) == plain_upsert([], expected, 100, False)
    before = read_tracking(spark, f"{root}/out", before=3)
    assert result(T.tracking_upsert(before, frame(spark, expected[2:]))) == plain_upsert([], expected, 100, False)
    assert len(glob.glob(f"{root}/out/scratch/*")) < 12  # overwritten by each batch, not piled up
