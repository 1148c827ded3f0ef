"""Centroid clustering by equal-average equal-variance search (operator 11).

A vector's mean and its deviation (length of what is left after taking the mean off) bound its
distance to a centroid from below: ``dims * (difference of means)^2 + (difference of
deviations)^2``. Centroids lie sorted by mean; a vector scans outward from its own mean, stops
where the means alone are too far apart, skips a centroid that both bounds reject, and works
out the others in integers. The bounds have a margin for rounding, so the nearest centroid is
exact. Rounds send a row for each task, centroid and component, never vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

CENTROIDS = 16
ROUNDS = 3
DIMS = 64
SCALE = 64
TILE = 4096  # vectors searched together
ADDED = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


class Codebook(NamedTuple):
    """Centroids in the order of their means; ``number`` is each one's own."""

    vectors: np.ndarray
    number: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray


def means_and_deviations(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean = vectors.mean(axis=1)
    return mean, np.sqrt(((vectors - mean[:, None]) ** 2).sum(axis=1))


def codebook(centroids: np.ndarray) -> Codebook:
    mean, deviation = means_and_deviations(centroids)
    order = np.argsort(mean, kind="stable")
    return Codebook(centroids[order], order.astype(np.int64), mean[order], deviation[order])


def nearest(vectors: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid's number and the squared distance of each integer vector; ties to the smaller number."""
    rows, dims = vectors.shape
    count = len(book.number)
    mean, deviation = means_and_deviations(vectors)
    best = np.full(rows, np.iinfo(np.int64).max)
    owner = np.full(rows, count)
    right = np.searchsorted(book.mean, mean)
    left = right - 1
    going = np.arange(rows)
    for _ in range(count):
        # the next centroid outward: the nearer by mean of the two at the ends of what was scanned
        below = np.where(left[going] >= 0, mean[going] - book.mean[np.maximum(left[going], 0)], np.inf)
        above = np.where(right[going] < count, book.mean[np.minimum(right[going], count - 1)] - mean[going], np.inf)
        down = below <= above
        at = np.where(down, left[going], right[going])
        left[going[down]] -= 1
        right[going[~down]] += 1
        by_mean = dims * np.minimum(below, above) ** 2
        so_far = best[going].astype(float)
        limit = so_far + 1 + 1e-3 * np.sqrt(so_far)
        on = by_mean <= limit
        going, at, by_mean, limit = going[on], at[on], by_mean[on], limit[on]
        if not len(going):
            break
        near = by_mean + (deviation[going] - book.deviation[at]) ** 2 <= limit
        found, place = going[near], at[near]
        distance = ((vectors[found] - book.vectors[place]) ** 2).sum(axis=1)
        number = book.number[place]
        better = (distance < best[found]) | ((distance == best[found]) & (number < owner[found]))
        best[found[better]] = distance[better]
        owner[found[better]] = number[better]
    return owner, best


def widest(dims: int) -> int:
    """Components must be below this for squared distances to fit 64 bits."""
    return int((2.0**62 / dims) ** 0.5 / 2)


def integer_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """Rows whose ``embedding`` has ``dims`` finite components, and ``__vector``: floor(scale * component)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    wide = F.raise_error(F.lit(f"a component leaves +-{widest(dims)} after scaling: distances would leave 64 bits"))

    def floor(x):
        value = F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")
        return F.when(F.abs(scale * x.cast("double")) < widest(dims), value).otherwise(wide.cast("long"))

    kept = vectors.filter((F.size("embedding") == dims) & finite)
    return kept.withColumn("__vector", F.transform("embedding", floor))


def matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("__vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: each centroid becomes the floor of its vectors' mean; one without vectors stays."""
    count, dims = centroids.shape
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = codebook(shared.value)
        total, rows = np.zeros((count, dims), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            every = matrix(batch, dims)
            for start in range(0, len(every), TILE):
                tile = every[start : start + TILE]
                owner, _ = nearest(tile, book)
                np.add.at(total, owner, tile)
                rows += np.bincount(owner, minlength=count)
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, dims)), pa.array(np.tile(np.arange(dims), len(used))),
             pa.array(total[used].ravel()), pa.array(np.repeat(rows[used], dims))], ["cluster", "place", "total", "n"])

    parts = vectors.select("__vector").mapInArrow(sums, "cluster long, place long, total long, n long")
    # decimals: sums over all vectors may leave 64 bits; a row for each centroid and component
    whole = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for row in whole.collect():
        moved[row.cluster, row.place] = int(row.total) // row.n
    return moved


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vectors`` with ``cluster`` and ``distance``, without ``__vector``."""
    dims = centroids.shape[1]
    columns = [c for c in vectors.columns if c != "__vector"]
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = codebook(shared.value)
        for batch in batches:
            every = matrix(batch, dims)
            parts = [nearest(every[start : start + TILE], book) for start in range(0, len(every), TILE)]
            if parts:
                owner, distance = (np.concatenate(part) for part in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in columns), pa.array(owner.astype(np.int32)), pa.array(distance)], [*columns, "cluster", "distance"])

    schema = vectors.select(columns).schema.add("cluster", "integer").add("distance", "long")
    return vectors.mapInArrow(found, schema)


def cluster(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = 1) -> DataFrame:
    """``vectors`` with a usable ``embedding``, their cluster, distance, inertias and the centroid's digest.

    Left out: rows whose embedding is null, has another length, or a null or non-finite
    component. Repeated rows count as often as they come, among the first centroids too.
    Centroids start as the vectors of least sha256 of ``seed:vec_id`` (a null id comes last;
    equal hashes by vector); fewer vectors than centroids make fewer centroids. Columns named
    like an added one are replaced; no rows give no rows. A component that is finite but too
    large for 64-bit distances stops the job with an error that says so.
    The centroids are all the driver holds: ``count * dims`` numbers.
    """
    spark = vectors.sparkSession
    plain = vectors.drop(*ADDED, "__vector")
    kept = materialize(integer_vectors(plain, dims, scale), "vectors")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.select(digest.alias("digest"), "__vector").orderBy(F.col("digest").asc_nulls_last(), "__vector").limit(count).collect()
    centroids = np.array([row["__vector"] for row in first], np.int64).reshape(len(first), dims)
    for _ in range(rounds if first else 0):
        centroids = next_centroids(kept, centroids)
    found = materialize(assigned(kept, centroids), "assigned")
    inertia = {row.cluster: int(row.total) for row in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()}
    names = [hashlib.sha256(",".join(map(str, vector.tolist())).encode()).hexdigest() for vector in centroids]
    facts = spark.createDataFrame(
        [(number, inertia.get(number, 0), sum(inertia.values()), name) for number, name in enumerate(names)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # a row a centroid: the hint sends `count` rows, whatever the table
    return found.join(F.broadcast(facts), "cluster").select(*plain.columns, *ADDED)


def op11_equal_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("embedding")


def _sql() -> str:
    steps = [f"""
    v as materialized (
      select vec_id, row_number() over () as k, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as e
      from embeddings where len(embedding) = {DIMS} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {DIMS}),
    x as materialized (select k, unnest(e) as x, unnest(range({DIMS})) as place from v),
    c0 as materialized (
      select number, unnest(e) as c, unnest(range({DIMS})) as place from (
        select row_number() over (order by sha256('1:' || vec_id::varchar), e) - 1 as number, e from v) where number < {CENTROIDS})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
    d{i} as materialized (
      select k, number, sum((x - c) * (x - c))::bigint as distance from x join c{i} using (place) group by k, number),
    a{i} as materialized (
      select k, number, distance from d{i} qualify row_number() over (partition by k order by distance, number) = 1)""")
        if i < ROUNDS:
            steps.append(f"""
    s{i} as materialized (
      select number, place, sum(x)::bigint as s, count(*) as n from x join a{i} using (k) group by number, place),
    c{i + 1} as materialized (
      select number, place, case when n is null then c else (s - ((s % n) + n) % n) // n end as c
      from c{i} left join s{i} using (number, place))""")
    last = ROUNDS
    return f"""with {','.join(steps)},
    f as (select number, sha256(string_agg(c::varchar, ',' order by place)) as centroid_sha256 from c{last} group by number)
    select vec_id, number::int as cluster, distance, (sum(distance) over (partition by number))::bigint as cluster_inertia,
      (sum(distance) over ())::bigint as inertia, centroid_sha256
    from v join a{last} using (k) join f using (number)"""


SQL = _sql()
