"""Ranked lexical search by dense blocked matrix multiplication (operator 12).

The items' terms are the whole vocabulary. Documents are read once into counts of these terms
(a row a document); the corpus statistics come from those rows. Then items go in tiles of 64,
each with a vocabulary of its own, documents in tiles of 1,024: weights times impacts is one
float64 product, exact because a tile of terms is cut so that no partial sum reaches 2^53.
A task keeps the best rows of each item by score and document; two windows join the tasks'.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, pieces, table

BEST = 50
BLOCK_TERMS = 100_000  # terms of items that are searched in one pass over the documents
TILE_ITEMS = 64
TILE_DOCS = 1024
TILE_TERMS = 4096
CHUNK = 1 << 20  # bytes of a text split at once
IMPACT = 10**6  # what an impact stays below
PARTS = 64  # groups in which the tasks' best rows are joined first


def in_terms(byte: int) -> bool:
    """ASCII digits and letters, and every byte of a character beyond ASCII."""
    return 0x30 <= byte <= 0x39 or 0x41 <= byte <= 0x5A or 0x61 <= byte <= 0x7A or byte >= 0x80


PLAIN = bytes((byte + 32 if 0x41 <= byte <= 0x5A else byte) if in_terms(byte) else 0x20 for byte in range(256))


def terms(text: bytes | None) -> Counter:
    """How often each term comes in a UTF-8 text; long texts are split piece by piece."""
    found: Counter = Counter()
    if text:
        plain, start = text.translate(PLAIN), 0
        while start < len(plain):
            end = plain.find(b" ", start + CHUNK)
            end = len(plain) if end < 0 else end
            found.update(plain[start:end].split())
            start = end
    return found


class Tile(NamedTuple):
    """Items of one tile and one cut of their terms: the weights, as triples of a matrix."""

    items: np.ndarray  # numbers of the items in the block
    terms: np.ndarray  # numbers of the terms in the vocabulary
    rows: np.ndarray
    columns: np.ndarray
    weights: np.ndarray


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id`` and its distinct terms, as bytes."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(terms(text)) for text in batch.column("text").cast(pa.binary()).to_pylist()]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            flat = pa.array([term for f in found for term in f], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(at)), flat], ["item_id", "term"])

    return items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        split, "item_id long, term binary").distinct()


def counted(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id``, ``n`` terms, and number and count of those in the vocabulary, of documents with a term."""
    shared = docs.sparkSession.sparkContext.broadcast({term: number for number, term in enumerate(vocabulary)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, n, numbers, counts, ends = [], [], [], [], [0]
            texts = batch.column("text").cast(pa.binary())
            for at in range(len(texts)):
                found = terms(texts[at].as_py())
                if not found:
                    continue
                ids.append(at)
                n.append(found.total())
                for term in known.keys() & found.keys():
                    numbers.append(known[term])
                    counts.append(found[term])
                ends.append(len(numbers))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(ids, pa.int64())), pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(numbers, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        count, "doc_id long, n long, terms array<int>, counts array<int>")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def tiles(owned: dict[int, set[int]], weights: np.ndarray) -> list[Tile]:
    """``owned``: each item's terms. Terms of weight 0, such as those of no document, are left out."""
    columns = min(TILE_TERMS, max(1, (1 << 53) // (IMPACT * max(1, int(weights.max(initial=1)))) - 1))
    made, items = [], sorted(owned)
    for start in range(0, len(items), TILE_ITEMS):
        group = items[start : start + TILE_ITEMS]
        vocabulary = sorted({term for item in group for term in owned[item] if weights[term] > 0})
        for low in range(0, len(vocabulary), columns):
            cut = {term: at for at, term in enumerate(vocabulary[low : low + columns])}
            cells = [(row, cut[term], weights[term]) for row, item in enumerate(group) for term in owned[item] & cut.keys()]
            rows, places, values = (np.array(part, np.int64) for part in zip(*cells))
            made.append(Tile(np.array(group), np.fromiter(cut, np.int64), rows, places, values))
    return made


class Best:
    """The best rows of an item so far: higher scores first, then smaller documents, null last."""

    def __init__(self, keep: int):
        self.keep = keep
        self.scores, self.docs, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """What a score must reach; equal scores are told apart by document."""
        return int(self.scores[-1]) if len(self.scores) == self.keep else 1

    def add(self, scores: np.ndarray, docs: np.ndarray, null: np.ndarray) -> None:
        scores, docs, null = (np.concatenate(pair) for pair in ((self.scores, scores), (self.docs, docs), (self.null, null)))
        order = np.lexsort((docs, null, -scores))[: self.keep]
        self.scores, self.docs, self.null = scores[order], docs[order], null[order]


def impacts(counts: np.ndarray, n: list[int], at: np.ndarray, documents: int, length: int) -> np.ndarray:
    spread = np.array([50 + (50 * each * documents) // length for each in n], np.int64)
    return (10**9 * counts) // (1000 * counts + 20 * spread[at])


def best_rows(rows: DataFrame, made: list[Tile], items: list[int | None], documents: int, length: int, keep: int) -> DataFrame:
    """Each task's best ``doc_id`` and ``score`` of every item."""
    shared = rows.sparkSession.sparkContext.broadcast((made, items))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, items = shared.value
        size = 1 + max((int(tile.terms.max()) for tile in made), default=0)
        groups: dict[tuple, list] = {}  # a tile of items, with all cuts of its terms
        for tile in made:
            dense = np.zeros((len(tile.items), len(tile.terms)))
            dense[tile.rows, tile.columns] = tile.weights
            place = np.full(size, -1, np.int32)
            place[tile.terms] = np.arange(len(tile.terms))
            groups.setdefault(tuple(tile.items), []).append((dense, place))
        best = {item: Best(keep) for group in groups for item in group}
        for batch in batches:
            for start in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(start, TILE_DOCS)
                lengths = np.diff(part.column("terms").offsets.to_numpy())
                numbers = part.column("terms").flatten().to_numpy().astype(np.int64)
                counts = part.column("counts").flatten().to_numpy().astype(np.int64)
                at = np.repeat(np.arange(part.num_rows), lengths)
                inside = numbers < size
                numbers, counts, at = numbers[inside], counts[inside], at[inside]
                values = impacts(counts, part.column("n").to_pylist(), at, documents, length).astype(float)
                docs = part.column("doc_id").fill_null(0).to_numpy()
                null = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                for group, cuts in groups.items():
                    scores = np.zeros((len(group), part.num_rows), np.int64)
                    for dense, place in cuts:
                        column = place[numbers]
                        own = column >= 0
                        held = np.zeros((dense.shape[1], part.num_rows))
                        held[column[own], at[own]] = values[own]
                        scores += (dense @ held).astype(np.int64)
                    for row in np.flatnonzero(scores.max(axis=1, initial=0) > 0):
                        kept = best[group[row]]
                        good = np.flatnonzero(scores[row] >= kept.least())
                        if len(good):
                            kept.add(scores[row][good], docs[good], null[good])
        task = TaskContext.get().partitionId() % PARTS
        for item, kept in best.items():
            if len(kept.scores):
                yield pa.RecordBatch.from_arrays([
                    pa.array([items[item]] * len(kept.scores), pa.int64()), pa.array(kept.docs, pa.int64(), mask=kept.null),
                    pa.array(kept.scores), pa.array([task] * len(kept.scores), pa.int32())], ["item_id", "doc_id", "score", "part"])

    return rows.mapInArrow(search, "item_id long, doc_id long, score long, part int")


def first_of(rows: DataFrame, keep: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def rank(docs: DataFrame, items: DataFrame, keep: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``keep`` best documents of each item with a score above 0.

    Ids are integers, or cast to them. Null and empty texts have no terms: such a document is
    not counted, such an item has no rows. Rows with one ``item_id`` are one item, null too;
    each row of ``docs`` is a document, so a repeated ``doc_id`` may come twice. Equal scores go
    by ascending ``doc_id``, null last. Other columns are not looked at; no rows give no rows.
    Items are searched in blocks of about ``block_terms`` terms, by hash of their id; each block
    reads the documents once, and is all that is sent to the tasks.
    """
    spark = docs.sparkSession
    wanted = materialize(item_terms(items), "item-terms")
    blocks = pieces(wanted.count(), block_terms)
    found = []
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block
        pairs = [(row.item_id, bytes(row.term)) for row in wanted.filter(mine).toLocalIterator()]
        if not pairs:
            continue
        vocabulary = sorted({term for _, term in pairs})
        ids = sorted({item for item, _ in pairs}, key=lambda item: (item is None, item))
        rows = materialize(counted(docs, vocabulary), "counted")
        documents, length = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
        holding = np.zeros(len(vocabulary), np.int64)
        for row in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).toLocalIterator():
            holding[row.term] = row.n
        if not holding.any():
            continue
        weights = np.array([weight(documents, int(n)) if n else 0 for n in holding], np.int64)
        number, at = {item: i for i, item in enumerate(ids)}, {term: i for i, term in enumerate(vocabulary)}
        owned: dict[int, set[int]] = {i: set() for i in range(len(ids))}
        for item, term in pairs:
            owned[number[item]].add(at[term])
        best = best_rows(rows, tiles(owned, weights), ids, documents, length, keep)
        found.append(best if blocks == 1 else materialize(best, "best"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return first_of(first_of(every, keep, "item_id", "part"), keep, "item_id").select("item_id", "rank", "doc_id", "score")


def op12_dense_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
with d as materialized (
  select doc_id, row_number() over () as k, text from documents),
words as materialized (
  select k, t as term, count(*) as tf from (
    select k, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from d) group by k, t),
sizes as materialized (select k, sum(tf)::bigint as n from words group by k),
totals as (select count(*) as docs, sum(n)::bigint as length from sizes),
wanted as materialized (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
weights as materialized (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from words, totals
  where term in (select term from wanted) group by term, docs),
scores as (
  select item_id, k, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // length))))::bigint as score
  from wanted join weights using (term) join words using (term) join sizes using (k), totals group by item_id, k)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from scores join d using (k) where score > 0 qualify rank <= 50
"""
