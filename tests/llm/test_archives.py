"""Operator 13: archives read back against plain digests, and the merge against sorting."""

from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from townvoice.llm import archives
from townvoice.session import shared_path

SCHEMA = "page_id long, url string, html string, record_type string, file int"
PAGES = [
    (5, "http://B.example.com/x?q=1", "<p>same</p>"), (3, "http://a.example.com/", "<p>same</p>"), (3, "http://a.example.com/", "<p>same</p>"),
    (None, "http://a.example.com/z", "<p>same</p>"), (7, None, None), (8, "", ""), (9, "no address", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
    (10, "http://a.example.com/ two\r\nX: y", "é東\x00\r\n\r\n"), (11, "http://[bad/", "x"), (12, "http://a.example.com:8080/p", "Ö" * 40_000),
    (None, None, "only null"), (None, None, "only null"), *[(100 + i, f"http://h{i % 7}.example.org/{i}", "hot") for i in range(300)],
    *[(500 + i, "http://hot.example.net/", f"page {i}") for i in range(200)],
]


def plain(rows, least=0):
    out = []
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")
    groups = {}
    for row in rows:
        groups.setdefault(row[2] or "", []).append(row)
    for payload, own in groups.items():
        data = payload.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        for at, row in enumerate(sorted(own, key=order)):
            first = at == 0 or len(data) < least
            out.append((row[0], len(data), digest, "response" if first else "revisit", None if first else min(own, key=order)[0]))
    return out


def built(spark, rows, parts=3, **options):
    path = shared_path(spark, "warc")
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA).repartition(parts)
    archives.write_archives(df, path, F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0)), **options)
    return path, archives.merged_index(archives.read_archives(spark, path), range_rows=options.get("range_rows", 100))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("parts, archive_bytes, least", [(1, 32 << 20, 0), (7, 4000, 0), (3, 20_000, 6)])
def test_read_back_equals_plain_digests(spark, parts, archive_bytes, least):
    path, index = built(spark, PAGES, parts, archive_bytes=archive_bytes, least_bytes=least)
    got = archives.resolved(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert ordered(map(tuple, got)) == ordered(plain(PAGES, least))


def test_index_is_one_order_and_finds_each_record(spark):
    path, index = built(spark, PAGES, 5, archive_bytes=3000)
    rows = index.orderBy("position").collect()
    assert [r.position for r in rows] == list(range(len(PAGES)))
    keys = [(r.url_key, r.captured, r.record_id) for r in rows]
    assert keys == sorted(keys) and len({r.archive for r in rows}) > 3
    history = [r.captured for r in rows if r.url_key == "net,example,hot)/"]
    assert len(history) == 200 and history == sorted(history)
    for r in rows[::40]:
        with open(r.archive.removeprefix("file:"), "rb") as file:
            file.seek(r.offset)
            text = gzip.decompress(file.read(r.length))
        assert text.startswith(b"WARC/1.1\r\n") and r.record_id.encode() in text and text.endswith(b"\r\n\r\n")
    for name in glob.glob(f"{path.removeprefix('file:')}/file=*/part-*"):
        assert gzip.open(name).read().startswith(b"WARC/1.1\r\n")  # any gzip reader reads a whole archive


def test_a_long_record_takes_several_members(spark, monkeypatch):
    monkeypatch.setattr(archives, "MEMBER", 1000)
    rows = [{"file": 0, "id": f"<urn:uuid:{i}>", "page": str(i), "url": "http://a/b", "captured": i, "bytes": n, "refers": None,
             "payload": "ab" * (n // 2), "digest": base64.b32encode(hashlib.sha1(b"ab" * (n // 2)).digest()).decode()} for i, n in enumerate([10, 5000, 0, 2600])]
    content = b"".join(archives.member(archives.record(row)) + b"\0" for row in rows)
    run = archives.captures_of(content, "x")
    assert [(int(r[4]), r[7]) for r in run] == [(0, 10), (1, 5000), (2, 0), (3, 2600)]
    assert sum(r[11] for r in run) == len(content)
    with pytest.raises(ValueError):
        archives.captures_of(content[:-30], "x")


def test_loser_tree_merges_runs():
    for seed in range(60):
        rng = random.Random(seed)
        runs = [sorted(rng.choices(range(20), k=rng.choice([0, 1, 5, 40]))) for _ in range(rng.randrange(0, 9))]
        keys, bounds = [k for run in runs for k in run], [0]
        for run in runs:
            bounds.append(bounds[-1] + len(run))
        merged = archives.loser_merge(keys, bounds)
        assert merged == sorted(range(len(keys)), key=lambda i: (keys[i], i))


def test_no_pages_no_archives(spark):
    path = shared_path(spark, "warc")
    archives.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert not archives.rows_written(spark, path)
