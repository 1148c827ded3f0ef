"""What to crawl next: search calls, backlog, detail calls and shards."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.times import batch_path
from ..session import materialize

FLAGGED = "clien"  # Fixed value: the source that gets extra calls.
BLOCK = 10_000  # calls of a source that one row is spread into


def keyword_lookup(keyword_set: DataFrame, name: str) -> DataFrame:
    """Keywords of a named set, no row if there is no such set."""
    return keyword_set.filter(F.col("name") == name).select(F.explode("keywords").alias("keyword"))


TASK_PREFIX = "invoke_lambda_"  # Fixed value: how the tasks of a call are named.


def task_id(function: Column, suffix: Column) -> Column:
    return F.replace(F.concat(F.lit(TASK_PREFIX), function, suffix), F.lit(" "), F.lit("_"))


def search_plan(keywords: DataFrame, functions: list[str], window: list[Column], dated: str = "extra", flagged: str = FLAGGED) -> DataFrame:
    """One search call per keyword and function, one more for functions of the flagged source.

    ``dated`` says which calls carry the date range: ``extra`` only the additional
    ones, ``base`` only the regular ones, ``all`` both.
    """
    if dated not in ("extra", "base", "all"):
        raise ValueError(f"dated must be extra, base or all, not {dated!r}")
    calls = []
    for function in functions:
        calls.append((function, False, dated != "extra"))
        if flagged in function.lower():
            calls.append((function, True, dated != "base"))
    entries = F.array(*[
        F.struct(F.lit(f).alias("function_name"), F.lit(extra).alias("extra"), F.lit(ranged).alias("_dated"))
        for f, extra, ranged in calls
    ])
    suffix = F.when(F.col("extra"), F.lit("_all")).otherwise(F.concat(F.lit("_"), "keyword"))
    checked_at, start_date, end_date = window
    return keywords.select(*keywords.columns, F.inline(entries)).select(
        *keywords.columns,
        "function_name",
        "extra",
        task_id(F.col("function_name"), suffix).alias("task_id"),
        checked_at,
        F.when(F.col("_dated"), start_date).alias("start_date"),
        F.when(F.col("_dated"), end_date).alias("end_date"),
    )


def backlog_counts(tracking: DataFrame, platforms: list[str], rule: str = "current") -> DataFrame:
    """Rows waiting per platform, 0 included. The older rule also counts BANNED rows."""
    done = {"current": ["UNCHANGED", "BANNED"], "older": ["UNCHANGED"]}[rule]
    counts = [
        F.count_if((F.col("platform") == name) & ~F.col("status").isin(done)) for name in platforms
    ]
    entries = F.array(*[
        F.struct(F.lit(name).alias("platform"), count.alias("backlog")) for name, count in zip(platforms, counts)
    ])
    return tracking.agg(entries.alias("entries")).select(F.inline("entries"))


def detail_plan(backlog: DataFrame, functions: list[tuple[str, str]], size: int, checked_at: str, flagged: str | None = FLAGGED, extra: int = 2) -> DataFrame:
    """Detail calls, ceil(backlog / size) per source, numbered round-robin.

    ``functions`` is (function, platform) in call order. A flagged source with backlog
    gets ``extra`` calls on top and filler calls up to the longest source; ``flagged=None``
    is the plain plan. Order the result by (func_id, source_pos) to submit it.
    """
    counts = []
    for function, platform in functions:
        waiting = F.max(F.when(F.col("platform") == platform, F.col("backlog")))
        calls = F.coalesce(F.ceil(waiting / size).cast("int"), F.lit(0))
        if flagged and flagged in function.lower():
            calls = F.when(calls > 0, calls + extra).otherwise(0)
        counts.append(calls)
    sources = F.array(*[
        F.struct(
            F.lit(pos).alias("source_pos"),
            F.lit(function).alias("function_name"),
            F.lit(bool(flagged and flagged in function.lower())).alias("flagged"),
            calls.alias("calls"),
        )
        for pos, ((function, _), calls) in enumerate(zip(functions, counts))
    ])
    # One row of len(functions) entries; the calls are spread out from it.
    plan = backlog.agg(sources.alias("sources")).select(
        F.array_max(F.transform("sources", lambda s: s["calls"])).alias("longest"), F.inline("sources")
    )
    width = F.when(F.col("flagged") & (F.col("calls") > 0), F.col("longest")).otherwise(F.col("calls"))
    filler = F.col("func_id") >= F.col("calls")
    # Blocks of calls are dealt out first, so that no task makes all calls of a source.
    first = F.explode(F.sequence(F.lit(0), F.col("_width") - 1, F.lit(BLOCK)))
    last = F.least(F.col("_width"), F.col("_first") + BLOCK) - 1
    return (
        plan.filter(F.col("calls") > 0)
        .withColumn("_width", width)
        .withColumn("_first", first)
        .repartition("source_pos", "_first")
        .select("*", F.explode(F.sequence(F.col("_first"), last)).alias("func_id"))
        .select(
            "func_id",
            "source_pos",
            "function_name",
            task_id(F.col("function_name"), F.when(filler, "_all").otherwise(F.col("func_id").cast("string"))).alias("task_id"),
            filler.alias("filler"),
            F.lit(checked_at).cast("timestamp_ntz").alias("checked_at"),
        )
    )


def assign_shards(tracking: DataFrame, size: int, spread: int = 3) -> DataFrame:
    """Give every waiting URL of a platform a shard of at most ``size`` URLs.

    URLs are numbered in hash order. The numbers come from counts per hash bucket
    (16 ** spread per platform) and a numbering inside each bucket, so a platform with
    most of the rows is still spread evenly; raise ``spread`` with the backlog.
    """
    pending = tracking.filter(~F.col("status").isin("UNCHANGED", "BANNED")).select(
        "platform", "url", F.md5(F.col("url").cast("binary")).alias("_hash")
    ).withColumn("_bucket", F.substring("_hash", 1, spread))
    buckets = pending.groupBy("platform", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("platform").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("platform", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("platform", "_bucket").orderBy("_hash", "url"))
    return (
        pending.withColumn("_inside", inside)
        .join(offsets, ["platform", "_bucket"])
        .select(
            "platform",
            "url",
            F.floor((F.col("_offset") + F.col("_inside") - 1) / size).cast("bigint").alias("shard"),
        )
    )


def run_log(runs: DataFrame, bucket: str, created_at: Column, style: str = "logged") -> DataFrame:
    """Log rows for runs (checked_at, keywords_str, platform, id) with their file paths.

    ``logged`` are the paths the log has always held, ``actual`` those the landing writes.
    """
    directory = F.concat(F.lit(f"s3://{bucket}/"), batch_path(F.col("checked_at")), F.lit("/"))
    if style == "logged":
        base = F.concat(directory, "keywords_str", F.lit("/"), "platform")
    elif style == "actual":
        base = F.concat(directory, "id", F.lit("_"), "platform")
    else:
        raise ValueError(f"style must be logged or actual, not {style!r}")
    return runs.select(
        "checked_at",
        "keywords_str",
        "platform",
        F.lit(bucket).alias("bucket_name"),
        F.concat(base, F.lit("_posts.parquet")).alias("posts_s3_path"),
        F.concat(base, F.lit("_comments.parquet")).alias("comments_s3_path"),
        created_at.alias("created_at"),
    )


def append_run_log(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Append log rows to the stored log, one per (checked_at, platform): rows it has are left out.

    Returns what was appended. The log is read by its two key columns only.
    """
    keys = ["checked_at", "platform"]
    fresh = rows.dropDuplicates(keys)
    try:
        known = spark.read.parquet(path).select(*keys)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        known = rows.select(*keys).limit(0)
    same = (F.col("f.checked_at") == F.col("k.checked_at")) & F.col("f.platform").eqNullSafe(F.col("k.platform"))
    added = materialize(fresh.alias("f").join(known.alias("k"), same, "left_anti"), "log-rows")
    added.write.mode("append").parquet(path)
    return added
