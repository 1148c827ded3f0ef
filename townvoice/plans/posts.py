"""From nested posts to landing, curated and warehouse tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import jobs
from ..functions.text import join_keywords, lenient_int
from ..operators import listing as L
from ..operators import normalize as N
from ..operators import summary as S
from ..session import shared_path
from ..sources import adapters as A
from ..sources import landing, sinks
from . import views as V
from .registry import query
from .summaries import flagged

CHECKED_AT = A.BATCH.replace(" ", "T")
AS_INT = r"case when regexp_full_match({0}, '[+-]?\d+') then cast({0} as bigint) end"
LANDED = f"""{V.NESTED},
landed as (
  select platform, title, post_id, url, content, "view", created_at, "like", cast(null as bigint) as dislike,
         cast(0 as bigint) as comment_count, keywords, cast(null as varchar) as sentiment, timestamp '{A.BATCH}' as checked_at, 'post' as kind
  from nested where status = 'UNCHANGED'
  union all
  select platform, null, post_id, null, line, null, null, case when pos % 3 <> 0 then pos end, null, null, null, null, timestamp '{A.BATCH}', 'comment'
  from lines where status = 'UNCHANGED')"""

_roots: dict[tuple, str] = {}


def landing_root(spark, sf):
    """A landing folder holding one batch, written once per session and scale."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _roots:
        root = shared_path(spark, "landing")
        landing.land_nested(N.keep_parsed(A.nested_posts(spark, sf)), root, CHECKED_AT, None, "d0")
        _roots[key] = root
    return _roots[key]


COLUMNS = V.MERGED.split("select ")[1].split(" from")[0]


@query("scan_batch", V.with_views(LANDED, f"select {COLUMNS}, kind from landed"))
def scan_batch(spark, sf):
    return landing.scan_batch(spark, landing_root(spark, sf), CHECKED_AT)


@query("scan_posts", V.with_views(LANDED, f"select {COLUMNS} from landed where kind = 'post'"))
def scan_posts(spark, sf):
    return landing.scan_posts(spark, landing_root(spark, sf), CHECKED_AT)


@query("scan_comments", V.with_views(LANDED, """select platform, created_at, content, "like", dislike, post_id, sentiment, checked_at from landed where kind = 'comment'"""))
def scan_comments(spark, sf):
    return landing.scan_comments(spark, landing_root(spark, sf), CHECKED_AT)


@query("scan_tolerant", V.with_views(LANDED, f"select {COLUMNS}, kind from landed"))
def scan_tolerant(spark, sf):
    root = shared_path(spark, "landing")
    nested = N.keep_parsed(A.nested_posts(spark, sf))
    landing.land_nested(nested, root, CHECKED_AT, None, "d0")
    # Text files under a Parquet name: unreadable, to be skipped.
    nested.select("title").write.text(f"{root}/{landing.batch_dir(CHECKED_AT)}/broken_posts.parquet")
    return landing.scan_tolerant(spark, root, CHECKED_AT)


@query("empty_batch_check", V.with_views(LANDED, "select kind, count(*) as n from landed group by kind"))
def empty_batch_check(spark, sf):
    return landing.empty_batch_check(scan_batch(spark, sf)).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("land_nested", V.with_views(LANDED, f"select {COLUMNS} from landed"))
def land_nested(spark, sf):
    root = shared_path(spark, "landing")
    landing.land_nested(N.keep_parsed(A.nested_posts(spark, sf)), root, CHECKED_AT, None, "d1")
    return landing.scan_batch(spark, root, CHECKED_AT).drop("kind")


@query("land_partitioned", V.with_views(V.posts(True), "select checked_at, count(*) as n, sum(\"view\")::bigint as views from posts group by 1"))
def land_partitioned(spark, sf):
    path = shared_path(spark, "partitioned")
    landing.land_partitioned(A.posts(spark, sf, many=True), path)
    return landing.scan_partitioned(spark, path).groupBy("checked_at").agg(F.count(F.lit(1)).alias("n"), F.sum("view").alias("views"))


@query("write_curated", V.with_views(LANDED, f"select {COLUMNS} from landed"))
def write_curated(spark, sf):
    rows = S.project_posts(scan_batch(spark, sf))
    return spark.read.parquet(sinks.write_curated(rows, shared_path(spark, "curated"), CHECKED_AT))


@query("write_summary", V.with_views(V.merged(), f"select timestamp '{A.BATCH}' as checked_at, {V.BASE_METRICS}, {V.totals(A.LATIN_LEXICON)} from merged"))
def write_summary(spark, sf):
    summary = S.batch_summary(flagged(spark, sf, A.LATIN_LEXICON), A.BATCH, A.LATIN_LEXICON)
    return spark.read.parquet(sinks.write_summary(summary, shared_path(spark, "curated"), CHECKED_AT))


WAREHOUSE = V.with_views(V.posts(True), "select checked_at, {} * count(*) as n, {} * sum(\"view\")::bigint as views from posts group by 1")


def _load(name, times, idempotent):
    @query(name, WAREHOUSE.format(times, times))
    def run(spark, sf):
        table = shared_path(spark, "warehouse")
        posts = A.posts(spark, sf, many=True)
        for _ in range(2):
            sinks.load_append(posts, table, idempotent)
        loaded = spark.read.parquet(table)
        return loaded.groupBy("checked_at").agg(F.count(F.lit(1)).alias("n"), F.sum("view").alias("views"))


_load("load_append", 2, False)
_load("load_append_idempotent", 1, True)


@query("flatten_comments", V.with_views(V.NESTED, "select platform, post_id, pos, line as content, case when pos % 3 = 0 then '1,000' else pos::varchar end as \"like\" from lines"))
def flatten_comments(spark, sf):
    nested = N.attach_batch(A.nested_posts(spark, sf), None, A.BATCH)
    _, comments = N.flatten_comments(nested)
    return comments.select("platform", "post_id", F.col("pos").cast("bigint").alias("pos"), "content", "like")


@query("count_comments", V.with_views(V.NESTED_EDGES, "select post_id, coalesce(len(lines), 0)::int as comment_count from nested"))
def count_comments(spark, sf):
    return N.count_comments(A.nested_posts(spark, sf, edges=True)).select("post_id", "comment_count")


@query("keep_parsed", V.with_views(V.NESTED_EDGES, "select post_id, status from nested where status = 'UNCHANGED'"))
def keep_parsed(spark, sf):
    return N.keep_parsed(A.nested_posts(spark, sf, edges=True)).select("post_id", "status")


@query("attach_batch", V.with_views(V.NESTED, f"select 'clien' as platform, timestamp '{A.BATCH}' as checked_at, post_id, content, keywords, \"like\" from nested"))
def attach_batch(spark, sf):
    landed = N.attach_batch(A.nested_posts(spark, sf), "clien", A.BATCH)
    assert "status" not in landed.columns
    return landed.select("platform", "checked_at", "post_id", "content", join_keywords(F.col("keywords")).alias("keywords"), lenient_int(F.col("like")).alias("like"))


@query("split_strict", f"select doc_id, lang as \"like\" from documents where doc_id % 2 = 0")
def split_strict(spark, sf):
    _, rejected = N.split_strict(A.nested_posts(spark, sf), "like")
    return rejected.select(F.col("post_id").cast("bigint").alias("doc_id"), "like")


@query("drop_blocked_comments", V.with_views(V.NESTED, """select post_id, pos, case when pos % 6 <> 5 then line end as content,
  case when pos % 6 <> 5 then pos end as "like", case when pos % 6 <> 5 then created_at end as created_at from lines where pos % 5 <> 4"""))
def drop_blocked_comments(spark, sf):
    nested = A.nested_posts(spark, sf).withColumnRenamed("created_at", "time")
    pos = F.col("pos").cast("bigint")
    rows = N.explode_comments(nested, "post_id", "time").select(
        "post_id", pos.alias("pos"), F.col("time").alias("created_at"), pos.alias("like"),
        F.when(pos % 6 == 5, F.concat(F.lit("  "), F.lit(N.DELETED_COMMENT), F.lit("."))).otherwise(F.col("content")).alias("content"),
        (pos % 5 == 4).alias("blocked"),
    )
    return N.drop_blocked_comments(rows)


DEFAULTS = f"""select d.platform, d.url, coalesce(d.title, '제목 없음') as title, coalesce(d.content, '본문 없음') as content,
  coalesce(d."view", t."view") as "view", coalesce(d.comment_count, t.comment_count) as comment_count,
  coalesce(d.created_at, t.created_at) as created_at, coalesce(d."like", 0) as "like"
from (select {V.site('l_orderkey')} as platform, '/o/' || l_orderkey as url, case when l_partkey % 2 = 0 then l_returnflag end as title,
  case when l_partkey % 3 = 0 then l_linestatus end as content, case when l_partkey % 5 = 0 then l_partkey::int end as "view",
  case when l_partkey % 7 = 0 then l_linenumber end as comment_count, case when l_partkey % 2 = 1 then l_shipdate end as created_at,
  case when l_partkey % 4 = 0 then l_suppkey end as "like" from lineitem) d left join tracking t using (platform, url)"""


@query("default_missing", V.with_views(V.TRACKING, DEFAULTS))
def default_missing(spark, sf):
    return N.default_missing(A.sparse_details(spark, sf), A.tracking(spark, sf))


LISTING = f"""listing as (select {V.site('user_id')} as source, event_type as keyword, -event_id as pos, user_id as post_id,
  ts - case when event_id % 997 = 0 then interval 20 days else interval 0 days end as created_at from events)"""
START, END = "2024-01-10 00:00:00", "2024-01-25 00:00:00"


def _listing_window(name, mode, condition):
    sql = f"""select source, keyword, pos, post_id, created_at from (select *, max(case when created_at < timestamp '{START}' then 1 else 0 end)
      over (partition by source, keyword order by pos rows unbounded preceding) as stopped from listing)
      where created_at between timestamp '{START}' and timestamp '{END}' {condition}"""

    @query(name, V.with_views(LISTING, sql))
    def run(spark, sf):
        return L.listing_window(A.listing_rows(spark, sf), A.F.lit(START).cast("timestamp_ntz"), A.F.lit(END).cast("timestamp_ntz"), mode)


_listing_window("listing_window", "take_while", "and stopped = 0")
_listing_window("listing_window_filter", "filter", "")

PAGED = f"""paged as (select {V.site('event_id')} as source, 'k' || event_id % 5 as keyword, event_id // 600 as page, event_id as pos,
  event_id - case when (event_id // 600) % (event_id % 5 + 3) = event_id % 5 + 2 then 600 else 0 end as post_id from events),
sets as (select source, keyword, page, list_sort(list_distinct(list(post_id))) as ids from paged group by all),
repeats as (select source, keyword, min(page) as page from (select *, lag(ids) over (partition by source, keyword order by page) as before from sets) where ids = before group by all)"""


@query("drop_repeated_pages", V.with_views(PAGED, "select p.* from paged p left join repeats r using (source, keyword) where r.page is null or p.page <= r.page"))
def drop_repeated_pages(spark, sf):
    return L.drop_repeated_pages(A.listing_pages(spark, sf))


@query("force_refresh_sentinel", V.with_views(V.HITS, 'select url, seq, keyword, -999 as "view", -999 as comment_count, \'CHANGED\' as status from hits'))
def force_refresh_sentinel(spark, sf):
    return L.force_refresh_sentinel(A.hits(spark, sf)).select("url", "seq", "keyword", "view", "comment_count", "status")


LANDED_SUMMARY = f"""select timestamp '{A.BATCH}' as checked_at, cast(sum("view") as bigint) as total_views, count(*) as total_posts_comments,
  cast(sum(case when sentiment = 'positive' then 1 end) as bigint) as positive, cast(sum(case when sentiment = 'neutral' then 1 end) as bigint) as neutral,
  cast(sum(case when sentiment = 'negative' then 1 end) as bigint) as negative, {V.totals(A.LATIN_LEXICON)} from landed"""


@query("transform_batch", V.with_views(LANDED, LANDED_SUMMARY))
def transform_batch(spark, sf):
    """The production job: landing files to curated rows to a stored summary."""
    _, summary = jobs.transform_batch(spark, landing_root(spark, sf), shared_path(spark, "output"), CHECKED_AT, A.LATIN_LEXICON)
    return spark.read.parquet(summary)


@query("backfill", V.with_views(LANDED, LANDED_SUMMARY))
def backfill(spark, sf):
    return jobs.backfill(spark, landing_root(spark, sf), A.LATIN_LEXICON)
