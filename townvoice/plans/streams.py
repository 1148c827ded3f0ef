"""Streaming queries, run over everything that has landed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.summary import project_posts
from ..session import shared_path
from ..sources import adapters as A
from ..sources.summary_table import late_rows, read_summary
from ..streaming.summary import landing_stream, stream_to_table
from . import views as V
from .registry import query
from .summaries import HISTORY_SQL, merged

NOON = "2025-02-24 12:00:00"


def streamed(spark, sf, deliveries):
    """The summary table after deliveries of rows, a micro-batch each."""
    root = shared_path(spark, "stream")
    rows = project_posts(merged(spark, sf, True))
    for n, delivery in enumerate(deliveries):
        part = rows.filter(delivery)
        part.filter(F.col("platform").isNotNull()).write.parquet(f"{root}/landing/{n}_posts.parquet")
        part.filter(F.col("platform").isNull()).write.parquet(f"{root}/landing/{n}_comments.parquet")
        stream_to_table(landing_stream(spark, f"{root}/landing"), f"{root}/summary", f"{root}/checkpoint", A.LATIN_LEXICON).awaitTermination()
    return f"{root}/summary"


@query("stream_summary", V.with_views(HISTORY_SQL, "select time_bucket(interval 5 minutes, checked_at) as period, * exclude (checked_at) from history"))
def run_stream_summary(spark, sf):
    """Two deliveries in the order of time, the second merged into the day of the first."""
    early = F.col("checked_at") < F.lit(NOON).cast("timestamp_ntz")
    return read_summary(spark, streamed(spark, sf, [early, ~early]), A.LATIN_LEXICON)


LATE = f"""select 'on time' as kind, count(distinct checked_at) as periods, count(*) as rows from merged where checked_at >= timestamp '{NOON}'
union all select 'late', count(distinct checked_at), count(*) from merged where checked_at < timestamp '{NOON}'
union all select 'reported late', 0, count(*) from merged where checked_at < timestamp '{NOON}'"""


@query("stream_summary_late", V.with_views(V.merged(True), LATE))
def run_stream_summary_late(spark, sf):
    """The afternoon first: the morning comes too late, is counted and kept apart."""
    early = F.col("checked_at") < F.lit(NOON).cast("timestamp_ntz")
    path = streamed(spark, sf, [~early, early])
    total, late = late_rows(spark, path)
    shown = read_summary(spark, path, A.LATIN_LEXICON).agg(
        F.lit("on time").alias("kind"), F.count(F.lit(1)).alias("periods"), F.sum("total_posts_comments").alias("rows"))
    apart = late.agg(F.lit("late").alias("kind"), F.countDistinct("checked_at").alias("periods"), F.count(F.lit(1)).alias("rows"))
    told = spark.createDataFrame([("reported late", 0, total)], "kind string, periods long, rows long")
    return shown.unionByName(apart).unionByName(told)
