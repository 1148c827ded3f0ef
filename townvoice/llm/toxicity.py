"""Toxicity by a linear classifier on character n-grams (operator 3).

Features are the hashed character n-grams that a lower-cased text holds, present or not.
Each is scaled by its naive Bayes log-count ratio between the classes; a logistic
regression learns the weights. It is fitted on a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_crc, materialize, small_batches, table

BITS = 18
GRAMS = (3, 4, 5)
SAMPLE = 8000  # labelled texts that the classifier is fitted on, at most: those of least hash
ROOM = 1 << 23  # features that these texts hold, at most; texts beyond are left out, those of greatest hash first
FOLDS, HELD = 5, 0
SMOOTHING = 1.0
LEAST_RATIO = 0.5  # log-count ratios nearer to 0 count as 0
PENALTY = 1e-4
ROUNDS = 200
CHUNK = 1 << 20  # characters hashed at once


class Model(NamedTuple):
    weights: np.ndarray  # of the 2**BITS features, ratios included
    bias: float


def features(text: str | None) -> np.ndarray:
    """The distinct features of a whole text, ascending; none for null or short texts."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    seen = np.zeros(1 << BITS, bool)
    for start in range(0, len(codes), CHUNK):
        part = codes[start : start + CHUNK + max(GRAMS) - 1]
        hashed = np.zeros(len(part), np.uint64)
        for n in range(1, max(GRAMS) + 1):
            if len(part) < n:
                break
            hashed = (hashed[: len(part) - n + 1] * np.uint64(0x9E3779B97F4A7C15)) ^ (part[n - 1 :] * np.uint64(0xC2B2AE3D27D4EB4F))
            if n in GRAMS:
                mixed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                seen[(mixed >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return np.flatnonzero(seen).astype(np.int32)


def log_ratios(positive: np.ndarray, negative: np.ndarray, n_positive: int, n_negative: int) -> np.ndarray:
    """Naive Bayes log-count ratio of each feature, from how many texts of a class hold it; near 0 is 0."""
    logs = [np.log((held + SMOOTHING) / (n + 2 * SMOOTHING)) for held, n in ((positive, n_positive), (negative, n_negative))]
    ratio = logs[0] - logs[1]
    ratio[np.abs(ratio) < LEAST_RATIO] = 0
    return ratio


def fit(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray) -> Model:
    """Weights from the features with a ratio that each text of the sample holds, and labels (0 or 1)."""
    base = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-4, 1 - 1e-4))
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(base / (1 - base))))
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    used, flat = np.unique(flat, return_inverse=True)
    scale, weights = ratio[used], np.zeros(len(used))
    balance = np.where(labels == 1, 0.5 / base, 0.5 / (1 - base))
    balance /= balance.sum()
    bias, moment, square = 0.0, np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, ROUNDS + 1):  # Adam on the whole sample
        score = np.bincount(owner, weights=(weights * scale)[flat], minlength=len(labels)) + bias
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels) * balance
        slope = np.append(scale * np.bincount(flat, weights=error[owner], minlength=len(used)) + PENALTY * weights, error.sum())
        moment, square = 0.9 * moment + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        change = 0.02 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - change[:-1], bias - change[-1]
    every = np.zeros(1 << BITS, np.float32)
    every[used] = weights * scale
    return Model(every, float(bias))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, room: int = ROOM) -> Model:
    """Fits on at most ``sample`` labelled documents outside the held-out fold, of ``room`` features together.

    Rows without a label or id are not used. An id is toxic if any of its labels is, and counts
    once: by the text of least hash if its texts differ. Ids are chosen before texts are read.
    One task fits the bounded sample; the driver gets the weights.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.filter((F.col("toxic").isin(0, 1)) & F.col("doc_id").isNotNull() & (id_crc() % FOLDS != HELD))
    order = F.xxhash64("doc_id", F.lit(3))
    chosen = (
        known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
        .orderBy(order, "doc_id").limit(sample)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch.doc_id, "label": batch.label, "features": [features(t).tobytes() for t in batch.text]})

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for label, own in zip(batch.label, batch.features):
                held[label][np.frombuffer(own, np.int32)] += 1
        some = np.flatnonzero(held.any(axis=0))
        yield pd.DataFrame({"feature": some, "negative": held[0][some], "positive": held[1][some]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = materialize(texts.mapInPandas(hashed, f"doc_id {kind}, label int, features binary"), "features")
    sizes = {row.label: row.n for row in found.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = found.mapInPandas(counted, "feature bigint, negative bigint, positive bigint").groupBy("feature").agg(
        F.sum("negative").alias("negative"), F.sum("positive").alias("positive")).toArrow()
    held = np.zeros((2, 1 << BITS))
    for row, name in enumerate(("negative", "positive")):
        held[row, counts.column("feature").to_numpy()] = counts.column(name).to_numpy()
    ratio = log_ratios(held[1], held[0], sizes.get(1, 0), sizes.get(0, 0))
    shared = spark.sparkContext.broadcast(ratio.astype(np.float32))

    # only features with a ratio go on
    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        useful = shared.value != 0
        for batch in batches:
            own = [np.frombuffer(f, np.int32) for f in batch.features]
            own = [f[useful[f]] for f in own]
            yield pd.DataFrame({"doc_id": batch.doc_id, "label": batch.label, "n": [len(f) for f in own], "features": [f.tobytes() for f in own]})

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, labels = [], []
        for batch in batches:
            rows += [np.frombuffer(f, np.int32) for f in batch.features]
            labels += batch.label.tolist()
        model = fit(rows, np.array(labels), shared.value.astype(float))
        yield pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    rows = materialize(found.mapInPandas(reduced, f"doc_id {kind}, label int, n bigint, features binary"), "useful")
    before = F.sum("n").over(Window.orderBy(order, "doc_id"))  # of the sample's numbers, not of its texts
    kept = rows.select("doc_id", "n").withColumn("sum", before).filter(F.col("sum") <= room).select("doc_id")
    one = rows.join(F.broadcast(kept), "doc_id").select("doc_id", "label", "features").repartition(1).sortWithinPartitions("doc_id")
    found = one.mapInPandas(fitted, "weights binary, bias double").collect()
    return Model(np.frombuffer(found[0].weights, np.float32), found[0].bias) if found else fit([], np.zeros(0), ratio)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) of every whole text; null and empty texts have the bias's.

    Other columns stay, a column of this name is replaced; repeated rows score alike.
    """
    small_batches(docs.sparkSession)
    plain = docs.drop("toxicity")
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, bias = shared.value
        for batch in texts:
            sums = np.array([weights[features(t)].sum(dtype=np.float64) for t in batch], float) + bias
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums, -30, 30))))

    return plain.withColumn("toxicity", F.pandas_udf(of, "double")("text"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5."""
    return score(docs, train(docs, labels)).filter("toxicity < 0.5").select(docs.columns)


def op3_naive_bayes_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs.select("doc_id", "text"), train(docs, table(spark, sf_dir, "labels")))
    return materialize(scored.select(
        "doc_id", (id_crc() % FOLDS == HELD).alias("held_out"), F.col("toxicity").alias("score")), "scores").select(
        "*", (F.col("score") >= 0.5).cast("int").alias("predicted"))
