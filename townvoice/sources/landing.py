"""Landing folders: one directory of Parquet files per batch and kind.

``{root}/{yyyy-MM-dd}/{H}/{m}/{id}_{platform}_{posts|comments}.parquet``. For a
backfill of many batches use the partitioned layout of :func:`land_partitioned`.

A landing is two writes. Its folder's journal (``_landings``) says when it began and when both
were done; scans leave out landings that began and were not committed. Files that no journal
names, as other tools write them, are read as they are. What began also names the URLs it
landed, so that :func:`unfinished_urls` can give them back after a crash.
"""

from __future__ import annotations

import re
import sys
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.normalize import attach_batch, land_columns
from ..schemas import COMMENTS_SCHEMA, POSTS_SCHEMA

PARTITIONS = ["date", "hour", "minute"]


def batch_dir(checked_at: str) -> str:
    """Directory of the batch started at ``yyyy-MM-ddTHH:mm:ss``; else ValueError."""
    started = datetime.strptime(checked_at, "%Y-%m-%dT%H:%M:%S")
    return f"{started:%Y-%m-%d}/{started.hour}/{started.minute}"


JOURNAL = "name string, platform string, checked_at string, attempt bigint, state string"


def landing_name(id: str, platform: str | None) -> str:
    name = f"{id}_{platform or 'all'}"
    if not re.fullmatch(r"[\w.-]+", name):
        raise ValueError(f"a landing's id and platform are letters, digits, dots and dashes: {name!r}")
    return name


def landings(spark: SparkSession, batches: str) -> DataFrame:
    """One row per landing of the batch folders ``batches`` (a glob is fine): its latest attempt and state.

    ``folder`` is the batch folder, as ``yyyy-MM-dd/H/m``.
    """
    try:
        rows = spark.read.schema(JOURNAL).json(f"{batches}/_landings")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"folder string, {JOURNAL}")
    # a commit is written after its beginning, and "committed" and "rolled back" end an attempt
    ended = F.struct("attempt", (F.col("state") != "begun").alias("ended"))
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+/[^/]+)/_landings/[^/]+$", 1)
    last = F.max_by(F.struct("platform", "checked_at", "attempt", "state"), ended).alias("last")
    return rows.select(folder.alias("folder"), "*").groupBy("folder", "name").agg(last).select("folder", "name", "last.*")


def _note(spark: SparkSession, root: str, checked_at: str, name: str, platform: str | None, attempt: int, state: str) -> None:
    row = spark.createDataFrame([(name, platform, checked_at, attempt, state)], JOURNAL)
    row.coalesce(1).write.mode("append").json(f"{root}/{batch_dir(checked_at)}/_landings")


def file_folder(path: Column) -> Column:
    """The batch folder of a file, as ``yyyy-MM-dd/H/m``, from its path.

    It is cut out for every row: a pattern, tried at each place of the path, costs far more.
    """
    return F.substring_index(F.substring_index(path, "/", -5), "/", 3)


def file_name(path: Column) -> Column:
    """The landing a file belongs to, from its path."""
    return F.regexp_extract(F.substring_index(path, "/", -3), r"/([^/]+)_(?:posts|comments)\.parquet(?:/[^/]*)?$", 1)


def _committed(df: DataFrame, root: str, checked_at: str) -> DataFrame:
    """Without the files of landings that are not complete: a handful of names."""
    states = landings(df.sparkSession, f"{root}/{batch_dir(checked_at)}")
    hidden = [row.name for row in states.filter("state <> 'committed'").select("name").collect()]
    return df.filter(~file_name(F.col("_metadata.file_path")).isin(hidden)) if hidden else df


def unfinished_urls(spark: SparkSession, root: str, checked_at: str, name: str) -> DataFrame:
    """The ``platform, url`` of the posts that a landing was to write."""
    return spark.read.schema("platform string, url string").parquet(f"{root}/{batch_dir(checked_at)}/_urls/{name}")


def _reader(spark: SparkSession, tolerant: bool):
    return spark.read.option("ignoreCorruptFiles", str(tolerant).lower())


def scan_batch(spark: SparkSession, root: str, checked_at: str, tolerant: bool = False) -> DataFrame:
    """Posts and comments of a batch as rows of the posts table, plus their ``kind``.

    Columns are found by name, so comments come out with NULL post columns, in one scan
    and without a job that merges schemas. A missing batch fails.
    """
    kind = F.when(F.col("_metadata.file_path").contains("_comments.parquet"), "comment").otherwise("post")
    rows = _reader(spark, tolerant).schema(POSTS_SCHEMA).parquet(f"{root}/{batch_dir(checked_at)}/*.parquet")
    return _committed(rows, root, checked_at).select("*", kind.alias("kind"))


def scan_posts(spark: SparkSession, root: str, checked_at: str, tolerant: bool = False) -> DataFrame:
    path = f"{root}/{batch_dir(checked_at)}/*_posts.parquet"
    return _committed(_reader(spark, tolerant).schema(POSTS_SCHEMA).parquet(path), root, checked_at)


def scan_comments(spark: SparkSession, root: str, checked_at: str, tolerant: bool = False) -> DataFrame:
    path = f"{root}/{batch_dir(checked_at)}/*_comments.parquet"
    return _committed(_reader(spark, tolerant).schema(COMMENTS_SCHEMA).parquet(path), root, checked_at)


def scan_tolerant(spark: SparkSession, root: str, checked_at: str) -> DataFrame:
    """Like :func:`scan_batch`, but files that cannot be read are skipped."""
    return scan_batch(spark, root, checked_at, tolerant=True)


def empty_batch_check(df: DataFrame) -> DataFrame:
    """Warn when the batch is empty; the job goes on."""
    if df.isEmpty():
        print("warning: the batch is empty", file=sys.stderr)
    return df


def land_nested(nested: DataFrame, root: str, checked_at: str, platform: str | None, id: str) -> None:
    """Type nested posts and write the batch's posts and comments; scans see both or neither.

    A landing that comes again replaces its files, and is not seen until it is complete.
    """
    spark, name, folder = nested.sparkSession, landing_name(id, platform), f"{root}/{batch_dir(checked_at)}"
    attached = attach_batch(nested, platform, checked_at.replace("T", " "))
    posts, comments = land_columns(attached)
    earlier = landings(spark, folder).filter(F.col("name") == name).agg(F.max("attempt")).first()[0]
    attempt = (earlier or 0) + 1
    attached.select("platform", "url").write.mode("overwrite").parquet(f"{folder}/_urls/{name}")
    _note(spark, root, checked_at, name, platform, attempt, "begun")
    posts.write.mode("overwrite").option("compression", "snappy").parquet(f"{folder}/{name}_posts.parquet")
    comments.write.mode("overwrite").option("compression", "snappy").parquet(f"{folder}/{name}_comments.parquet")
    _note(spark, root, checked_at, name, platform, attempt, "committed")


def rolled_back(spark: SparkSession, root: str, checked_at: str, name: str, platform: str | None, attempt: int) -> None:
    """Note that an attempt's URLs were given back, so that nobody does so again."""
    _note(spark, root, checked_at, name, platform, attempt, "rolled back")


def with_batch_partitions(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "date": F.to_date("checked_at"),
        "hour": F.hour("checked_at"),
        "minute": F.minute("checked_at"),
    })


def land_partitioned(df: DataFrame, path: str, mode: str = "append") -> None:
    """Many batches in one job, partitioned by batch time for pruning.

    Rows are gathered by batch first, which keeps files few; a huge batch is split.
    """
    with_batch_partitions(df).hint("rebalance", *PARTITIONS).write.mode(mode).partitionBy(*PARTITIONS).parquet(path)


def scan_partitioned(spark: SparkSession, path: str, checked_at: str | None = None) -> DataFrame:
    """One batch of the partitioned layout, or all of them. Only its directories are read."""
    df = spark.read.parquet(path)
    if checked_at is not None:
        date, hour, minute = batch_dir(checked_at).split("/")
        df = df.filter((F.col("date") == F.lit(date).cast("date")) & (F.col("hour") == int(hour)) & (F.col("minute") == int(minute)))
    return df.drop(*PARTITIONS)


