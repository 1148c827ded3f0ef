"""Language identification by bit-sliced Bloom filters (operator 8).

One table of slots holds a bit for each language. An n-gram's slots, combined by AND, give
all languages whose filter has it. A text's n-grams are looked up together; the hits of a
language, corrected for the share of its filter that is full (false positives), decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_crc, materialize, small_batches, table

GRAM = 3
SLOT_BITS = 18
HASHES = 3
FOLDS, HELD = 4, 2
SAMPLE = 4000  # texts of a language that its filter is filled from, at most: those of least hash
LEAST_SHARE = 0.02  # of its texts that hold an n-gram, else it is left out
CHUNK = 1 << 20  # characters looked up at once


class Filters(NamedTuple):
    languages: list[str]
    slots: np.ndarray  # (words, 2**SLOT_BITS) uint64: bit l of word w is language 64 * w + l
    false: np.ndarray  # for each language: the share of foreign n-grams its filter reports


def grams(text: str) -> np.ndarray:
    """A 64-bit hash of each n-gram of the lower-cased letters, words padded by a space."""
    plain = regex.sub(r"[^\p{L}\p{M}]+", " ", f" {text.lower()} ")
    codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    hashed = np.zeros(len(codes), np.uint64)
    for n in range(min(GRAM, len(codes))):
        hashed = hashed[: len(codes) - n] * np.uint64(0x9E3779B97F4A7C15) + codes[n:] + np.uint64(1)
    hashed = (hashed ^ (hashed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (hashed ^ (hashed >> np.uint64(29))) if len(codes) >= GRAM else hashed[:0]


def slots_of(hashed: np.ndarray, i: int) -> np.ndarray:
    return ((hashed >> np.uint64(i * SLOT_BITS)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def train(docs: DataFrame, sample: int = SAMPLE) -> Filters:
    """Fills the filters from documents with a language, outside the held-out fold.

    At most ``sample`` different texts of each language, those of least hash, whatever the order of rows; an n-gram enters a language's filter if
    ``LEAST_SHARE`` of these texts, and two where there are several, hold it.
    """
    small_batches(docs.sparkSession)
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (id_crc() % FOLDS != HELD)).select(
        "lang", "text", F.xxhash64("doc_id", "text", F.lit(8)).alias("order"))
    # a row a text of a language, however often it comes
    orders = materialize(known.groupBy("lang", "order").agg(F.count(F.lit(1)).alias("rows")), "orders")
    total = orders.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    # hashes are spread evenly: a threshold leaves about twice the sample to rank
    near = orders.join(total, "lang").filter(
        F.shiftrightunsigned("order", 11) / F.lit(float(1 << 53)) * F.col("texts") <= 2 * sample + 100)
    key = F.shiftrightunsigned("order", 11)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(key, "order"))
    chosen = materialize(near.withColumn("place", place).filter(F.col("place") <= sample).select("lang", "order"), "chosen")
    # the last key of each language lets pass little more than the sample: only that is shuffled.
    # A stored row a language, so Spark sends the table while it is small
    last = materialize(chosen.groupBy("lang").agg(F.max(key).alias("last")), "last")
    texts = known.join(last, "lang").filter(key <= F.col("last")).groupBy("lang", "order").agg(F.first("text").alias("text")).join(
        chosen, ["lang", "order"], "left_semi")

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, dict[int, int]] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.lang, batch.text):
                own = counts.setdefault(lang, {})
                texts[lang] = texts.get(lang, 0) + 1
                for gram in np.unique(grams(text or "").view(np.int64)).tolist():
                    own[gram] = own.get(gram, 0) + 1
        for lang, own in counts.items():
            yield pd.DataFrame({"lang": lang, "gram": np.fromiter(own, np.int64, len(own)), "n": np.fromiter(own.values(), np.int64, len(own))})
            yield pd.DataFrame({"lang": [lang], "gram": [None], "n": [texts[lang]]})

    parts = materialize(texts.select("lang", "text").mapInPandas(found, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")), "grams")
    seen = parts.filter("gram is null").select("lang", F.col("n").alias("texts"))
    least = F.greatest(F.least(F.lit(2), F.col("texts")), F.col("texts") * LEAST_SHARE)
    kept = parts.filter("gram is not null").join(seen, "lang").filter(F.col("n") >= least).select("lang", "gram").toPandas()
    languages = sorted(row.lang for row in seen.select("lang").collect())
    slots = np.zeros((max(1, -(-len(languages) // 64)), 1 << SLOT_BITS), np.uint64)
    false = np.zeros(len(languages))
    for at, lang in enumerate(languages):
        hashed = kept.gram[kept.lang == lang].to_numpy(np.int64).view(np.uint64)
        bit = np.uint64(1 << (at % 64))
        for i in range(HASHES):
            slots[at // 64, slots_of(hashed, i)] |= bit
        false[at] = ((slots[at // 64] & bit) != 0).mean() ** HASHES
    return Filters(languages, slots, false)


def guess(text: str | None, filters: Filters) -> tuple[str, float]:
    """The language with most corrected hits, and their share of all n-grams.

    ``und`` and 0 if the text is null or has no letter, or no language is known. Of equal
    languages the first by name.
    """
    if not text or not filters.languages or not regex.search(r"\p{L}", text):
        return "und", 0.0
    hits, total = np.zeros(len(filters.languages)), 0
    for start in range(0, len(text), CHUNK):
        hashed = grams(text[start : start + CHUNK + GRAM - 1] if len(text) > CHUNK else text)
        total += len(hashed)
        places = [slots_of(hashed, i) for i in range(HASHES)]
        for word, row in enumerate(filters.slots):
            masks = row[places[0]]
            for place in places[1:]:
                masks = masks & row[place]
            for at in range(64 * word, min(64 * word + 64, len(filters.languages))):
                hits[at] += np.count_nonzero(masks & np.uint64(1 << (at % 64)))
    share = np.clip((hits / max(total, 1) - filters.false) / (1 - np.minimum(filters.false, 0.999)), 0.0, 1.0)
    best = int(np.argmax(share))
    return filters.languages[best], float(share[best])


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of every whole text; columns of these names are replaced.

    Repeated rows are judged alike; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    plain = docs.drop("lang_pred", "score", "__guess")
    shared = docs.sparkSession.sparkContext.broadcast(tuple(filters))

    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Filters(*shared.value)
        for batch in texts:
            yield pd.DataFrame([guess(text, known) for text in batch], columns=["lang_pred", "score"])

    guessed = F.pandas_udf(of, "lang_pred string, score double")("text")
    return plain.withColumn("__guess", guessed).select(*plain.columns, "__guess.lang_pred", "__guess.score")


def op8_bloom_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text", (id_crc() % FOLDS == HELD).alias("held_out")), train(docs)).drop("text")
