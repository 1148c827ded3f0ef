"""The jobs, for ``spark-submit run.py`` or from Python.

    run.py search    --checked_at 2025-02-24T13:45:03 --pages PATH --table PATH
    run.py detail    --checked_at 2025-02-24T13:45:03 --pages PATH --table PATH --landing PATH --id d0
    run.py recover   --checked_at 2025-02-24T13:45:03 --table PATH --landing PATH
    run.py transform --checked_at 2025-02-24T13:45:03 --landing PATH --output PATH
    run.py load      --checked_at 2025-02-24T13:45:03 --output PATH --warehouse PATH
    run.py backfill  --landing PATH --warehouse PATH
    run.py track     --hits PATH --table PATH --checkpoint PATH

``search`` and ``detail`` read tables of fetched pages; ``--replies`` names the labels' table,
``--log`` the run log. ``transform`` and ``load`` take ``--split`` to keep comments apart.
``track`` folds a stream of hits into the table: what is there, or every ``--every 5 minutes``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collect
from .functions.times import crawl_window, ntz
from .lexicon import DEFAULT_LEXICON, Lexicon
from .operators.summary import batch_summary, project_posts, summary_history
from .schemas import COMMENTS_SCHEMA, HITS_SCHEMA, POSTS_SCHEMA
from .session import materialize
from .sources.landing import batch_dir, empty_batch_check, file_folder, file_name, landings, scan_comments, scan_tolerant
from .sources.ledger import listed
from .sources.sinks import load_append, write_curated, write_summary
from .streaming.tracking import stream_tracking


def transform_batch(spark: SparkSession, landing: str, output: str, checked_at: str, lexicon: Lexicon = DEFAULT_LEXICON, files: int | None = None, split: bool = False) -> tuple[str, str]:
    """Write a batch's curated rows and its summary; returns both paths.

    The landing files are read once: the summary is taken from the curated rows. ``split``
    writes posts and comments apart, in their own columns.
    """
    rows = empty_batch_check(scan_tolerant(spark, landing, checked_at))
    if split:
        curated = write_curated(project_posts(rows.filter("kind = 'post'")), output, checked_at, files)
        comments = write_curated(scan_comments(spark, landing, checked_at, tolerant=True), output, checked_at, files, kind="comments")
        stored = spark.read.schema(POSTS_SCHEMA).parquet(curated, comments)
    else:
        curated = write_curated(project_posts(rows), output, checked_at, files)
        stored = spark.read.schema(POSTS_SCHEMA).parquet(curated)
    return curated, write_summary(batch_summary(stored, checked_at.replace("T", " "), lexicon), output, checked_at)


def load_batch(spark: SparkSession, output: str, warehouse: str, checked_at: str, idempotent: bool = False, split: bool = False) -> None:
    """Append a batch's curated rows and summary to the warehouse tables, with ``split`` its comments too."""
    where = batch_dir(checked_at)
    load_append(spark.read.schema(POSTS_SCHEMA).parquet(f"{output}/posts/{where}/posts.parquet"), f"{warehouse}/post", idempotent)
    if split:
        load_append(spark.read.schema(COMMENTS_SCHEMA).parquet(f"{output}/comments/{where}/comments.parquet"), f"{warehouse}/comment", idempotent)
    load_append(spark.read.parquet(f"{output}/summary/{where}/summary.parquet"), f"{warehouse}/summary", idempotent)


def backfill(spark: SparkSession, landing: str, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """The summaries of all landed batches, from one scan and one small shuffle.

    Landings that are not complete are left out. A batch that landed without rows has the row
    that :func:`transform_batch` gives it: no sums, 0 rows.
    """
    batches = f"{landing}/*/*/*"
    rows = spark.read.schema(POSTS_SCHEMA).option("ignoreCorruptFiles", "true").parquet(f"{batches}/*.parquet")
    # the folder is the batch: a row without a time belongs to the batch it lies in
    path = F.col("_metadata.file_path")
    placed = rows.select("*", file_folder(path).alias("folder"), file_name(path).alias("name"))
    noted = materialize(landings(spark, batches), "landings")
    hidden = noted.filter("state <> 'committed'").select("folder", "name")
    if not hidden.isEmpty():
        placed = placed.join(hidden, ["folder", "name"], "left_anti")
    times = materialize(placed.groupBy("folder").agg(F.max("checked_at").alias("_time")), "batch-times")
    began = noted.filter("state = 'committed'").groupBy("folder").agg(F.max(F.to_timestamp_ntz("checked_at", F.lit("yyyy-MM-dd'T'HH:mm:ss"))).alias("_began"))
    named = F.coalesce("_time", "_began", F.to_timestamp_ntz("folder", F.lit("yyyy-MM-dd/H/m")))
    known = times.join(began, "folder", "left").select("folder", named.alias("_time"))
    stamped = placed.join(known, "folder").withColumn("checked_at", F.coalesce("checked_at", "_time"))
    history = summary_history(stamped.drop("folder", "name", "_time"), lexicon)
    seen = listed(spark, batches).filter("state is null or state = 'committed'").select("folder").distinct()
    silent = seen.join(times.select("folder"), "folder", "left_anti").join(began, "folder", "left").withColumn("_time", F.lit(None).cast("timestamp_ntz"))
    blank = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in history.schema.fields}
    blank |= {"checked_at": named.alias("checked_at"), "total_posts_comments": F.lit(0).cast("bigint").alias("total_posts_comments")}
    return history.unionByName(silent.select(*blank.values()))


NEEDED = {
    "search": ["checked_at", "pages", "table"], "detail": ["checked_at", "pages", "table", "landing", "id"],
    "recover": ["checked_at", "table", "landing"], "transform": ["checked_at", "landing", "output"],
    "load": ["checked_at", "output", "warehouse"], "backfill": ["landing", "warehouse"], "track": ["hits", "table", "checkpoint"],
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="run.py")
    parser.add_argument("job", choices=list(NEEDED))
    for name in ("checked_at", "landing", "output", "warehouse", "pages", "table", "id", "replies", "log", "hits", "checkpoint", "every"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--limit", type=int)
    for name in ("idempotent", "split"):
        parser.add_argument(f"--{name}", action="store_true")
    given = parser.parse_args(arguments)
    missing = [name for name in NEEDED[given.job] if getattr(given, name) is None]
    if missing:
        parser.error(f"{given.job} needs --{' --'.join(missing)}")
    if given.checked_at:
        try:
            batch_dir(given.checked_at)
        except ValueError:
            parser.error("--checked_at must look like yyyy-MM-ddTHH:mm:ss")
    spark = SparkSession.builder.appName(f"townvoice-{given.job}").getOrCreate()
    if given.job == "search":
        _, start, end = crawl_window(ntz(given.checked_at.replace("T", " ")))
        collect.search(spark, spark.read.parquet(given.pages), given.table, given.checked_at, start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))
    elif given.job == "detail":
        replies = spark.read.parquet(given.replies) if given.replies else None
        collect.detail(spark, spark.read.parquet(given.pages), given.table, given.landing, given.checked_at, given.id, replies, given.limit, given.log)
    elif given.job == "recover":
        collect.recover(spark, given.landing, given.checked_at, given.table)
    elif given.job == "transform":
        transform_batch(spark, given.landing, given.output, given.checked_at, split=given.split)
    elif given.job == "load":
        load_batch(spark, given.output, given.warehouse, given.checked_at, given.idempotent, given.split)
    elif given.job == "track":
        trigger = {"processingTime": given.every} if given.every else {"availableNow": True}
        stream_tracking(spark.readStream.schema(HITS_SCHEMA).parquet(given.hits), given.table, given.checkpoint, **trigger).awaitTermination()
    else:
        load_append(backfill(spark, given.landing), f"{given.warehouse}/summary", given.idempotent)


if __name__ == "__main__":
    main()
