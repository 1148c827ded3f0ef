"""WARC archives with revisit records, and their index by an external merge (operator 13).

Writing: of equal payloads one record keeps the payload, found by an aggregation whose partial
rows are one a task and payload; the others become revisit records that carry no payload and
never move one. Records are gzip members of their own, so any record can be read by its offset.

Reading: each archive is parsed and its payloads digested anew. Its captures, sorted by URL key
and time, are a run. Ranges of the key order hold slices of all runs; a loser tree merges the
slices of a range, and counts of the ranges before give each capture its place in the one order
of all archives, in which a URL's captures stand together as its history.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, pieces, running_total, shared_path, table

ARCHIVE_BYTES = 32 << 20  # of records before compression, in an archive
RANGE_ROWS = 200_000  # captures that one task merges
LEAST_BYTES = 0  # smaller payloads are always written whole
MEMBER = (1 << 24) - 1  # bytes of a record in one gzip member at most, see `member`
CHUNK = 1 << 16
FIRST_CAPTURE = 1_704_067_200  # 2024-01-01, where pages have no time of their own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = "file long, id string, page string, url string, captured long, digest string, bytes long, refers string, payload string"
CAPTURES = (
    "url_key string, captured string, record_id string, record_type string, page_id string, url string, "
    "payload_digest string, payload_bytes long, refers_record string, archive string, offset long, length long, place int")


def base32_of_hex(digest: Column) -> Column:
    """RFC 4648 base32 of 40 hex digits: 5 digits are 4 characters."""
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_name(page: str, url: str, captured: str, key: str, copy) -> Column:
    fields = F.struct(F.col(page).alias("page"), F.col(url).alias("url"), F.col(captured).alias("captured"), F.col(key).alias("key"), copy.alias("copy"))
    digest = F.md5(F.to_json(fields))
    cuts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def records(pages: DataFrame, captured: Column | None = None, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """A row for each record to write, with the number of its archive.

    The response among equal payloads is the row of smallest ``page_id`` (null last; then by URL
    and time; of wholly equal rows any one). Archives are cut by the hash that payloads are
    aggregated by, so that writing them moves no payload again.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    seen = pages.select(
        F.col("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce((F.lit(FIRST_CAPTURE) if captured is None else captured).cast("long"), F.lit(0)).alias("captured"),
        payload.alias("payload"), F.octet_length(payload).cast("long").alias("bytes"))
    seen = seen.withColumn("key", F.sha2("payload", 256)).withColumn("digest", base32_of_hex(F.sha1("payload")))
    order = [F.col("page_id").isNull().alias("last"), "page_id", "url", "captured"]
    rows = materialize(seen.groupBy("page_id", "url", "captured", "key", "digest", "bytes").agg(F.count(F.lit(1)).alias("n")), "captures")
    least = rows.filter(F.col("bytes") >= least_bytes).groupBy("key").agg(F.min(F.struct(*order)).alias("first"))

    total = rows.agg(F.sum(F.col("n") * 600) + F.sum("bytes")).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = pieces(total, archive_bytes * parts)
    file = F.pmod(F.hash("key"), F.lit(parts * each)).cast("long")
    name = record_name("page_id", "url", "captured", "key", F.col("copy"))
    fields = [file.alias("file"), name.alias("id"), F.col("page_id").cast("string").alias("page"), "url", "captured", "digest", "bytes"]

    whole = (
        seen.filter(F.col("bytes") >= least_bytes).groupBy("key").agg(
            F.min(F.struct(*order, "digest", "bytes", "payload")).alias("first")).select("key", "first.*")
        .withColumn("copy", F.lit(0).cast("long")).select(*fields, F.lit(None).cast("string").alias("refers"), "payload")
    )
    first = F.struct(*[F.col(f"first.{c}").alias(c) for c in ("page_id", "url", "captured")])
    same = F.struct("page_id", "url", "captured").eqNullSafe(first)
    copies = (
        rows.join(least, "key").select(*rows.columns, "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
        .filter(~(same & (F.col("copy") == 0)))
        .withColumns({"first_page": F.col("first.page_id"), "first_url": F.col("first.url"), "first_captured": F.col("first.captured")})
        # revisits have no payload and go by their own name: a payload's copies spread over all archives
        .select(F.pmod(F.hash("key", "page_id", "url", "copy"), F.lit(parts * each)).cast("long").alias("file"), *fields[1:],
                record_name("first_page", "first_url", "first_captured", "key", F.lit(0).cast("long")).alias("refers"),
                F.lit(None).cast("string").alias("payload"))
        .repartition("file")
    )
    made = whole.unionByName(copies)
    if least_bytes > 0:
        small = seen.filter(F.col("bytes") < least_bytes).withColumn("copy", F.monotonically_increasing_id())
        made = made.unionByName(small.select(*fields, F.lit(None).cast("string").alias("refers"), "payload"))
    return made


def member(data: bytes) -> bytes:
    """``data`` as gzip, without the last byte, which is 0.

    A member ends with its length, so its last byte is 0 below 2^24 bytes; longer data become
    several members. Spark's text writer, told that lines end with a zero byte, puts it back.
    """
    made = []
    for start in range(0, len(data), MEMBER):
        packer = zlib.compressobj(5, zlib.DEFLATED, 31)
        made.append(packer.compress(data[start : start + MEMBER]) + packer.flush())
    return b"".join(made)[:-1]


def record(row: dict) -> bytes:
    """One WARC record. Control characters and blanks of a URL are percent-encoded in its header."""
    payload = (row["payload"] or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    block = http if row["refers"] else http + payload
    fields = [
        ("WARC-Type", "revisit" if row["refers"] else "response"), ("WARC-Record-ID", row["id"]),
        ("WARC-Date", datetime.fromtimestamp(row["captured"], timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")),
        ("WARC-Target-URI", row["url"] and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"])),
        ("Page-ID", row["page"]), ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("WARC-Profile", PROFILE if row["refers"] else None), ("WARC-Refers-To", row["refers"]),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, captured: Column | None = None, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record for each row of ``pages`` below ``path``.

    ``captured``: the time of capture in seconds. Null html is an empty payload; a null URL or
    id leaves out its header; repeated rows are records of their own; other columns are not
    looked at; no rows write no archive. Files come by Spark's commit, so tasks may fail and
    run again. They are gzipped WARC, whatever their suffix.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, made, size = [], [], 0
            for row in batch.to_pylist():
                files.append(row["file"])
                made.append(member(record(row)))
                size += len(made[-1])
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(files, pa.int64()), pa.array(made, pa.binary())], ["file", "value"])
                    files, made, size = [], [], 0
            if files:
                yield pa.RecordBatch.from_arrays([pa.array(files, pa.int64()), pa.array(made, pa.binary())], ["file", "value"])

    made = records(pages, captured, least_bytes, archive_bytes).mapInArrow(packed, "file long, value binary")
    made.select("file", F.col("value").cast("string").alias("value")).write.partitionBy("file").option("lineSep", "\0").text(path)


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and data of each gzip member."""
    view, start = memoryview(content), 0
    while start < len(content):
        engine, parts, at = zlib.decompressobj(31), [], start
        while not engine.eof:
            if at >= len(content):
                raise ValueError(f"the member at {start} is cut off")
            parts.append(engine.decompress(view[at : at + CHUNK]))
            at = min(at + CHUNK, len(content))
        end = at - len(engine.unused_data)
        yield start, end - start, b"".join(parts)
        start = end


def url_key(url: str | None) -> str:
    """The URL with its host's labels turned round, as indexes sort it: ``com,example)/path``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host, port = parts.hostname, parts.port
    except ValueError:
        return url
    if not host:
        return url
    rest = f"{parts.path or '/'}{'?' + parts.query if parts.query else ''}"
    return f"{','.join(reversed(host.split('.')))}{f':{port}' if port else ''}){rest}"


def captures_of(content: bytes, archive: str) -> list[tuple]:
    """The records of one archive, by URL key, time and record: a run."""
    found, held, start = [], b"", 0
    for offset, length, data in members(content):
        start = start if held else offset
        held += data
        head_end = held.find(b"\r\n\r\n")
        if head_end < 0:
            continue
        version, *lines = held[:head_end].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        block_start, size = head_end + 4, int(fields["Content-Length"])
        if len(held) < block_start + size + 4:
            continue  # a long record goes on in the next member
        block = held[block_start : block_start + size]
        if version != "WARC/1.1" or held[block_start + size :] != b"\r\n\r\n":
            raise ValueError(f"{archive}: no record at {start}")
        http_end = block.index(b"\r\n\r\n") + 4
        digest, refers, payload_bytes = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields.get("WARC-Refers-To"), None
        if refers is None:
            payload = memoryview(block)[http_end:]
            payload_bytes = len(payload)
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"{archive}: the payload at {start} has another digest")
        url = fields.get("WARC-Target-URI")
        found.append((
            url_key(url), re.sub(r"\D", "", fields["WARC-Date"]), fields["WARC-Record-ID"], fields["WARC-Type"], fields.get("Page-ID"), url,
            digest, payload_bytes, refers, archive, start, offset - start + length))
        held = b""
    if held:
        raise ValueError(f"{archive}: the record at {start} is cut off")
    return sorted(found, key=lambda capture: capture[:3])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives below ``path``; ``place`` is a capture's place in its archive's run.

    Payloads are digested again and must have the digest their record says; a record that is
    cut off or ends elsewhere stops the job.
    """
    names = [part.strip().split(" ")[0] for part in CAPTURES.split(",")]

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(name, pa.int32() if name == "place" else pa.int64() if name in ("payload_bytes", "offset", "length") else pa.string())
                            for name in names])
        for batch in batches:
            for at in range(batch.num_rows):
                run = captures_of(batch.column("content")[at].as_py(), batch.column("path")[at].as_py())
                columns = list(zip(*(row + (place,) for place, row in enumerate(run)))) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(parsed, CAPTURES)


def loser_merge(keys: list, bounds: list[int]) -> list[int]:
    """Places of ``keys`` in ascending order; run i is ``keys[bounds[i]:bounds[i + 1]]``, sorted.

    Inner nodes of the tree keep the loser of their match, so that the next row of the winning
    run meets only the losers on its way up: one comparison a level. Of equal keys the earlier run's.
    """
    count = len(bounds) - 1
    heads, tree, merged = bounds[:-1], [-1] * max(count, 1), []

    def wins(one: int, other: int) -> bool:
        if heads[one] == bounds[one + 1] or heads[other] == bounds[other + 1]:
            return heads[one] < bounds[one + 1]
        a, b = keys[heads[one]], keys[heads[other]]
        return a < b or (a == b and one < other)

    def play(run: int) -> None:
        node = (run + count) // 2
        while node:
            if tree[node] < 0:  # the first to come waits for the other side
                tree[node] = run
                return
            if wins(tree[node], run):
                tree[node], run = run, tree[node]
            node //= 2
        tree[0] = run

    for run in range(count):
        play(run)
    while count and heads[tree[0]] < bounds[tree[0] + 1]:
        run = tree[0]
        merged.append(heads[run])
        heads[run] += 1
        play(run)
    return merged


def merged_index(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``captures`` with ``position``: their place by URL key, time and record over all archives.

    A range of the order holds about ``range_rows`` captures, so a URL with very many is cut by
    time. Written sorted, so a history is found by the files' least and greatest keys.
    """
    captures = materialize(captures, "runs")
    ranges = pieces(captures.count(), range_rows)
    order = ("url_key", "captured", "record_id")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        slices = pa.Table.from_batches(held)
        run = slices.column("archive").combine_chunks().dictionary_encode().indices.to_numpy()
        slices = slices.take(pa.array(np.lexsort((slices.column("place").to_numpy(), run))))
        keys = list(zip(*(slices.column(c).to_pylist() for c in order)))
        bounds = [0, *np.cumsum(np.bincount(run)).tolist()]
        whole = slices.take(pa.array(loser_merge(keys, bounds))).append_column("rank", pa.array(np.arange(len(keys))))
        whole = whole.append_column("piece", pa.array([TaskContext.get().partitionId()] * len(keys), pa.int64()))
        yield from whole.to_batches()

    pieced = captures.repartitionByRange(ranges, *order).mapInArrow(
        merge, f"{CAPTURES}, rank long, piece long")
    merged = materialize(pieced, "index")
    counts = merged.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    before = materialize(running_total(counts, "piece", "n", "before").select("piece", "before"), "index-offsets")
    return merged.join(before, "piece").withColumn("position", F.col("before") + F.col("rank")).drop("piece", "before", "rank")


def resolved(index: DataFrame, page_type: str = "long") -> DataFrame:
    """``index`` with ``page_id`` typed, ``refers_to`` and the payload size of a revisit from its response.

    A revisit whose response is in no archive has null for both.
    """
    heads = index.filter("record_type = 'response'").select(
        F.col("record_id").alias("head"), F.col("page_id").alias("head_page"), F.col("payload_bytes").alias("head_bytes"))
    return index.join(heads, F.col("refers_record") == F.col("head"), "left").select(
        F.col("page_id").cast(page_type).alias("page_id"), F.coalesce("payload_bytes", "head_bytes").alias("payload_bytes"),
        "payload_digest", "record_type", F.col("head_page").cast(page_type).alias("refers_to"),
        "url_key", "url", "captured", "position", "archive", "offset", "length")


def op13_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = shared_path(spark, "warc")
    write_archives(pages, path, F.lit(FIRST_CAPTURE) + F.col("page_id") % (365 * 86400))
    if not rows_written(spark, path):
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return resolved(merged_index(read_archives(spark, path))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def rows_written(spark: SparkSession, path: str) -> bool:
    """Whether any archive was written: no rows make no files."""
    return not spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "part-*").load(path).select("path").isEmpty()


SQL = """
with p as (select page_id, coalesce(html, '') as payload from pages),
h as (
  select page_id, octet_length(encode(payload)) as payload_bytes, sha1(payload) as hex,
    first_value(page_id) over (partition by payload order by page_id) as first from p)
select page_id, payload_bytes::bigint as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, (1 + (i // 4) * 5)::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31), 1)), '') as payload_digest,
  case when first = page_id then 'response' else 'revisit' end as record_type,
  case when first <> page_id then first end as refers_to
from h
"""
