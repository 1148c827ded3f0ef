"""Removal of repeated passages by longest-previous-factor arrays (operator 1).

Every byte that lies in a string of ``size`` bytes which also starts earlier goes; the first
occurrence stays. Strings are compared as bytes, within and across documents.

1. *Anchors.* Of the 32-byte grams of each string of ``size`` bytes the one of least hash
   is its anchor. Equal strings have equal anchors, so only strings around an anchor that
   occurs twice can repeat. The strings of one anchor at one place are a segment.
2. *Classes.* Segments of equal content are one class; all but the earliest are wholly
   repeated. Spark aggregates them before the shuffle, however many copies there are.
3. *Longest previous factors.* For the classes of an anchor the suffixes at all string starts
   are sorted. The previous and next suffix that starts earlier in the corpus give the
   longest previous match; where it reaches ``size`` the string is a repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, small_batches, table

SIZE = 100  # bytes
GRAM = 32
FILTER_BITS = (20, 29)  # least and most bits, as powers of 2, of the filter of repeated anchors: 64 MB
CHUNK = 4 << 20  # bytes whose suffixes are sorted at once, about
MANY = 20_000  # classes of one anchor that are sorted in one task, at most
SENT = 1_000_000  # spans that are broadcast, at most: about 40 bytes each
PLACE = ["doc_id", "text_key", "start"]  # where a segment starts, in order of precedence
GOLDEN, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def at_each(data: bytes, kind: str) -> np.ndarray:
    """The integer of ``kind`` that starts at each byte."""
    width = np.dtype(kind).itemsize
    return np.ndarray((max(0, len(data) - width + 1),), kind, data, strides=(1,))


def segments(data: bytes, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first string start, number of string starts, anchor place of each segment."""
    if len(data) < size:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    hashed = at_each(data, "<u4") * np.uint32(0x9E3779B1)
    width = 4
    while width < GRAM:
        hashed = (hashed[:-width] * np.uint32(0x85EBCA6B + 2 * width)) ^ (hashed[width:] * np.uint32(0xC2B2AE35))
        hashed ^= hashed >> np.uint32(15)
        width *= 2
    least = (hashed.astype(np.uint64) << np.uint64(32)) | np.arange(len(hashed), dtype=np.uint64)
    wanted, width = size - GRAM + 1, 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if wanted > width:
        least = np.minimum(least[: width - wanted], least[wanted - width :])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    anchor = place[first]
    long = at_each(data, "<u8")
    folded = np.full(len(first), GRAM, np.uint64)
    for i in range(0, GRAM, 8):
        folded = (folded ^ long[anchor + i]) * GOLDEN
        folded = (folded ^ (folded >> np.uint64(29))) * MIX
        folded ^= folded >> np.uint64(32)
    return folded, first, np.diff(np.append(first, len(place))), anchor


def anchor_counts(docs: DataFrame, size: int) -> DataFrame:
    """``anchor, n``: how often each anchor occurs, where it does twice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [segments(text.as_py().encode("utf-8", "surrogatepass"), size)[0] for text in batch.column(0)]
            hashes, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], names=["anchor", "n"])

    counted = docs.select("text").mapInArrow(count, "anchor bigint, n bigint")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")


def anchor_filter(repeated: DataFrame) -> tuple[int, np.ndarray]:
    """A filter of bounded size that holds all repeated anchors, and some others.

    A bit for each value of the anchors' first bits. What it lets through besides is a
    class of one segment later, so its size changes the work and not the result.
    """
    n = repeated.count()
    bits = int(np.clip(int(np.ceil(np.log2(16 * max(n, 1)))), *FILTER_BITS))
    place = F.shiftrightunsigned("anchor", 64 - bits)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            places = batch.column(0).to_numpy()
            for part in np.unique(places >> 16):
                own = held.setdefault(int(part), np.zeros(1 << 16, bool))
                own[places[places >> 16 == part] & 0xFFFF] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()), pa.array([np.packbits(b).tobytes() for b in held.values()], pa.binary())], names=["part", "bits"])

    # a part of the filter comes whole from one task
    parts = 1 << max(0, bits - 22)
    packed = repeated.select(place.alias("place")).repartition(parts, F.shiftright("place", 16)).mapInArrow(pack, "part bigint, bits binary")
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in packed.toLocalIterator():
        part = np.frombuffer(row.bits, np.uint8)
        out[row.part * len(part) : (row.part + 1) * len(part)] |= part
    return bits, out


def candidates(docs: DataFrame, known: tuple[int, np.ndarray], size: int, contents: bool) -> DataFrame:
    """``anchor, content_hash, doc_id, text_key, start, n, content`` of segments whose anchor passes the filter.

    Without ``contents`` the last is null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held = shared.value

        def packed(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 7
            kinds = [*[pa.int64()] * 4, pa.int32(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "content_hash", "doc_id", "text_key", "start", "n", "content"])

        for batch in batches:
            rows, volume = [], 0
            for doc_id, text_key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = text.as_py().encode("utf-8", "surrogatepass")
                hashes, first, n, place = segments(data, size)
                index = hashes >> np.uint64(64 - bits)
                hit = (held[(index >> np.uint64(3)).astype(np.int64)] >> (7 - (index & np.uint64(7))).astype(np.uint8)) & 1 == 1
                for anchor, start, count, at in zip(hashes[hit].view(np.int64).tolist(), first[hit].tolist(), n[hit].tolist(), place[hit].tolist()):
                    content = data[start : start + count + size - 1]
                    own = xxhash.xxh3_64_intdigest(content, seed=at - start)
                    rows.append((anchor, own - (1 << 63), doc_id, text_key, start, count, content if contents else None))
                    volume += len(content)
                if volume > CHUNK:
                    yield packed(rows)
                    rows, volume = [], 0
            yield packed(rows)

    return docs.select("doc_id", "text_key", "text").mapInArrow(
        find, "anchor bigint, content_hash bigint, doc_id bigint, text_key bigint, start int, n int, content binary")


def dense(values: np.ndarray) -> np.ndarray:
    """The rank of each value among the distinct ones."""
    order = np.argsort(values)
    ordered = values[order]
    ranks = np.empty(len(values), np.uint64)
    ranks[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]).astype(np.uint64)
    return ranks


def repeated_starts(contents: list[bytes], size: int = SIZE) -> np.ndarray:
    """For the string starts of all contents in turn: whether an equal string comes earlier.

    Contents are in order of precedence. Suffixes are ranked by 8, 16, 32, ... bytes, at
    last by ``size``; in that order the nearest smaller starts on both sides are the
    candidates for the longest previous factor.
    """
    lengths = np.array([len(c) for c in contents])
    text = b"".join(contents)
    ranks = dense(at_each(text + b"\0" * 7, ">u8").astype(np.uint64))
    width, total = 8, np.uint64(len(text) + 1)
    while 2 * width <= size:
        after = np.concatenate([ranks[width:], np.zeros(min(width, len(ranks)), np.uint64)])
        ranks = dense(ranks * total + after)
        width *= 2
    ends = np.cumsum(lengths)
    starts = np.ones(len(text), bool)
    for back in range(1, size):  # the last size - 1 bytes of a content start no string
        starts[ends - back] = False
    starts = np.flatnonzero(starts)
    keys = ranks[starts] * total + ranks[starts + size - width]
    order = np.argsort(keys)
    ordered = keys[order]
    n = len(order)
    run = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    place = order.astype(np.int64)
    # running minima from both sides; the shift by run starts them anew in each run
    left = place - run * (n + 1)
    right = (place - (run[-1] - run) * (n + 1))[::-1]
    earlier = np.zeros(n, bool)
    earlier[1:] |= np.minimum.accumulate(left)[:-1] < left[1:]
    earlier[:-1] |= (np.minimum.accumulate(right)[:-1] < right[1:])[::-1]
    out = np.empty(n, bool)
    out[order] = earlier
    return out


def factor_spans(classes: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_key, start, stop`` of what the earliest segments of the classes repeat of each other."""

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda row: row[1:4])
        contents = [row[4] for row in rows]
        found = repeated_starts(contents, size)
        counts = np.array([len(c) - size + 1 for c in contents])
        owner = np.repeat(np.arange(len(rows)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        opens = found & ~np.concatenate([[False], found[:-1] & (owner[1:] == owner[:-1])])
        closes = found & ~np.concatenate([found[1:] & (owner[1:] == owner[:-1]), [False]])
        first, last = np.flatnonzero(opens), np.flatnonzero(closes)
        of = owner[first]
        doc_id, text_key, start = (np.array([row[i] for row in rows], np.int64)[of] for i in (1, 2, 3))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_id), pa.array(text_key), pa.array(start + inside[first]), pa.array(start + inside[last] + size)],
            names=["doc_id", "text_key", "start", "stop"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, volume, group = [], 0, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if group and group[0][0] != row[0]:
                    if len(group) > 1:
                        ready += group
                        volume += sum(len(r[4]) for r in group)
                    group = []
                    if volume > CHUNK:
                        yield spans(ready)
                        ready, volume = [], 0
                group.append(row)
        ready += group if len(group) > 1 else []
        if ready:
            yield spans(ready)

    return (
        classes.select("anchor", "first.doc_id", "first.text_key", "first.start", "content").repartition("anchor")
        .sortWithinPartitions("anchor").mapInArrow(walk, "doc_id bigint, text_key bigint, start bigint, stop bigint")
    )


def string_spans(classes: DataFrame, size: int) -> DataFrame:
    """The same for anchors with very many classes: a row for each string, its earliest by aggregation."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text_key, start, content in zip(*(batch.column(i).to_pylist() for i in range(4))):
                n = len(content) - size + 1
                keys = [xxhash.xxh3_128_hexdigest(content[i : i + size]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array([doc_id] * n, pa.int64()), pa.array([text_key] * n, pa.int64()), pa.array(range(start, start + n), pa.int64())],
                    names=["key", *PLACE])

    every = materialize(classes.select("first.doc_id", "first.text_key", "first.start", "content").mapInArrow(
        strings, "key string, doc_id bigint, text_key bigint, start bigint"), "strings")
    first = every.groupBy("key").agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return every.join(first, "key").filter(F.struct(*PLACE) != F.col("first")).select(
        *PLACE, (F.col("start") + size).alias("stop"))


def merged(spans: DataFrame) -> DataFrame:
    """``doc_id, text_key, spans``: overlapping and touching spans of a text joined, in order."""
    text = ["doc_id", "text_key"]
    own = Window.partitionBy(*text).orderBy("start", "stop")
    reach = F.max("stop").over(own.rowsBetween(Window.unboundedPreceding, -1))
    opens = spans.withColumn("opens", (F.coalesce(F.col("start") > reach, F.lit(True))).cast("int"))
    numbered = opens.withColumn("span", F.sum("opens").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy(*text, "span").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return joined.groupBy(*text).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def repeated_spans(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, text_key, spans``: the byte ranges of each text that also start earlier, where there are any."""
    small_batches(docs.sparkSession)
    texts = docs.filter("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").filter(F.octet_length("text") >= size)
    repeated = materialize(anchor_counts(texts, size).select("anchor"), "anchors")
    # texts are read once more for contents, so that only those that are compared travel
    found = materialize(candidates(texts, anchor_filter(repeated), size, False).drop("content"), "segments")
    keys = ["anchor", "content_hash"]
    first = F.min(F.struct(*PLACE)).alias("first")
    # all but the earliest segment of a class
    earliest = found.groupBy(*keys).agg(first, F.count(F.lit(1)).alias("count"))
    later = found.join(earliest.filter("count > 1"), keys).filter(F.struct(*PLACE) != F.col("first")).select(
        "doc_id", "text_key", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("n") + size - 1).cast("long").alias("stop"))
    # the earliest ones, compared with those of other classes of the anchor
    per_anchor = found.select(*keys).distinct().groupBy("anchor").agg(F.count(F.lit(1)).alias("classes"))
    several = materialize(per_anchor.filter("classes > 1"), "several")
    compared = candidates(texts, anchor_filter(several), size, True)
    classes = compared.groupBy(*keys).agg(first, F.first("content").alias("content"))
    many = several.filter(F.col("classes") > MANY).select("anchor")
    if many.take(1):
        many = materialize(many, "many")
        spans = later.unionByName(factor_spans(classes.join(many, "anchor", "left_anti"), size)).unionByName(
            string_spans(classes.join(many, "anchor", "left_semi"), size))
    else:
        spans = later.unionByName(factor_spans(classes, size))
    return merged(spans)


def without_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: what is removed of each text, and the other bytes.

    ``spans`` are ``start, stop`` byte offsets, maximal and in order. Null counts as the empty
    text; texts shorter than ``size`` stay whole; a document without an id stays whole and is
    nobody's earlier copy. Rows with one id and one text are one document, so neither is the
    earlier one; rows with one id and other texts are documents of their own, by hash of text.
    Other columns are ignored; no rows give no rows. Ids are integers.
    """
    found = materialize(repeated_spans(docs, size), "spans")
    total = found.agg(F.sum(F.size("spans"))).first()[0] or 0
    sent = F.broadcast(found) if total <= SENT else found
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), data.alias("data")).join(sent, ["doc_id", "text_key"], "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start: bigint, stop: bigint>>"))
    start = F.struct(F.lit(b"").alias("kept"), F.lit(0).cast("long").alias("at"))

    def keep(state, span):
        piece = F.substring(F.col("data"), (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        return F.struct(F.concat(state["kept"], piece).alias("kept"), span["stop"].alias("at"))

    end = F.struct(F.octet_length("data").cast("long").alias("start"), F.octet_length("data").cast("long").alias("stop"))
    kept = F.when(F.size(spans) > 0, F.aggregate(F.concat(spans, F.array(end)), start, keep)["kept"]).otherwise(F.col("data"))
    return rows.select("doc_id", F.octet_length("data").cast("long").alias("n_bytes"), spans.alias("spans"), kept.alias("kept"))


def op1_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["stop"] - span["start"])
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
