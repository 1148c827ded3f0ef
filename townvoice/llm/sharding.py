"""Sharding by a two-pass external shuffle (operator 7), DataFrame functions only.

Pass 1 scatters records over buckets by a seeded hash. The number of buckets follows the
bytes, so that one bucket fits in a task's memory. Pass 2 puts each bucket in random order
with a Fisher-Yates shuffle (Spark's ``shuffle``) and writes it. The order of buckets and
the order inside them is one permutation of all records; dealing it out in turn gives
shards whose row counts differ by one at most (law ``rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, pieces, running_total, table

SHARDS = 16
BUCKET_BYTES = 16 << 20  # of text in a bucket: what one task holds
ROW_BYTES = 128  # counted for each record besides its text


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus 1; 1 for null."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def external_shuffle(docs: DataFrame, shards: int = SHARDS, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` in random order, dealt to shards: its columns, ``size``, ``shard`` and ``slot``.

    Every row is one record: null ids or texts, empty texts and repeated rows stay as they
    are. The hash takes the row's place in the input, not its content, so that equal rows
    scatter too. Columns of ``docs`` named like an added one are replaced. No rows give
    no rows.
    """
    sized = docs.withColumn("size", text_size(F.col("text")))
    total = sized.agg(F.sum(F.col("size") + ROW_BYTES)).first()[0]
    buckets = pieces(total, bucket_bytes)
    columns = [c for c in sized.columns if c not in ("shard", "slot")]
    scattered = sized.select(
        F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.lit(buckets)).alias("__bucket"),
        F.struct(*columns).alias("__record"),
    )
    shuffled = (
        scattered.repartition(buckets, "__bucket")
        .groupBy("__bucket").agg(F.shuffle(F.collect_list("__record"), seed).alias("__records"))
        .select("__bucket", F.posexplode("__records").alias("__rank", "__record"))
    )
    # written once: a second run of a shuffle would give another order
    kept = materialize(shuffled, "shuffled")
    counts = kept.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n")).withColumn("__key", F.col("__bucket"))
    # one row a bucket; a stored table has a known size, so Spark sends it only while it is small
    offsets = materialize(running_total(counts, "__key", "__n", "__before").select("__bucket", "__before"), "offsets")
    place = F.col("__before") + F.col("__rank")
    return kept.join(offsets, "__bucket").select(
        "__record.*", (place % shards).cast("int").alias("shard"), F.floor(place / shards).cast("long").alias("slot"))


def write_shards(shuffled: DataFrame, path: str, files: int = 4) -> None:
    """One folder a shard, in slot order within each of its files (``files`` a shard)."""
    part = F.floor(F.col("slot") / F.greatest(F.lit(1), F.lit(1 << 20))) % files
    shuffled.withColumn("__part", part).repartition("shard", "__part").drop("__part").sortWithinPartitions(
        "shard", "slot").write.partitionBy("shard").parquet(path)


def op7_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return external_shuffle(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
