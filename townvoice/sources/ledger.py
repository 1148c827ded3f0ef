"""What lies in a landing, file by file, beside what was read of it.

The files come from a listing: no file is opened for it. Anti-joined with the files that rows
came from, it names those that gave none.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import POSTS_SCHEMA
from .landing import file_name, landings

MAGIC = "PAR1"  # Fixed value: a Parquet file begins and ends with it.
FOLDER = r"([^/]+/[^/]+/[^/]+)/[^/]+(?:\.parquet/[^/]+)$|([^/]+/[^/]+/[^/]+)/[^/]+\.parquet$"


def listed(spark: SparkSession, batches: str) -> DataFrame:
    """``path, bytes, name, folder, state`` of the data files below batch folders; ``state`` is their landing's, null if none."""
    try:
        files = spark.read.format("binaryFile").load(f"{batches}/*.parquet")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "folder string, name string, path string, bytes bigint, state string")
    folder = F.coalesce(F.nullif(F.regexp_extract("path", FOLDER, 1), F.lit("")), F.regexp_extract("path", FOLDER, 2))
    named = files.select("path", F.col("length").alias("bytes"), file_name(F.col("path")).alias("name"), folder.alias("folder"))
    return named.join(landings(spark, batches).select("folder", "name", "state"), ["folder", "name"], "left").select(
        "folder", "name", "path", "bytes", "state")


def file_ledger(spark: SparkSession, batches: str) -> DataFrame:
    """Each data file with the ``rows`` read of it and an ``outcome``.

    ``read``; ``hidden`` (its landing is not committed); ``unreadable`` (no Parquet file, or
    broken); ``empty`` (read, no rows). Only files without rows are looked into: their first
    and last bytes tell an empty file from another one; a broken one is opened once more.
    """
    files = listed(spark, batches)
    rows = spark.read.schema(POSTS_SCHEMA).option("ignoreCorruptFiles", "true").parquet(f"{batches}/*.parquet")
    counts = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    found = files.join(counts, "path", "left")
    silent = [row.path for row in found.filter("rows is null").select("path").collect()]
    broken = unreadable(spark, silent)
    hidden = F.coalesce(F.col("state") != "committed", F.lit(False))
    outcome = (
        F.when(hidden, "hidden").when(F.col("rows").isNotNull(), "read")
        .when(F.col("path").isin(broken) if broken else F.lit(False), "unreadable").otherwise("empty"))
    return found.select("folder", "name", "path", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"), outcome.alias("outcome"))


def unreadable(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of ``paths``, files that gave no rows, that are no whole Parquet files."""
    if not paths:
        return []
    content = spark.read.format("binaryFile").load(paths)
    ends = [F.substring("content", 1, 4), F.substring("content", -4, 4)]
    odd = (F.col("length") < 12) | (ends[0] != F.lit(MAGIC).cast("binary")) | (ends[1] != F.lit(MAGIC).cast("binary"))
    return [row.path for row in content.filter(odd).select("path").collect()]
