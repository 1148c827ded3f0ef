"""Crawl state and planning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import crawl_window, ntz
from ..operators import planning as P
from ..operators import tracking as T
from ..session import materialize, shared_path
from ..sources import adapters as A
from ..sources import tracking_table as store
from ..streaming.tracking import read_tracking, stream_tracking
from ..schemas import HITS_SCHEMA
from . import views as V
from .registry import ORACLES, query

FUNCTIONS = ["bobae search", "clien_search", "dc_search"]
DETAILS = [("bobae detail", "bobaedream"), ("clien_detail", "clien"), ("dc_detail", "dcinside")]


def as_text(df):
    """Keyword lists as text, so that results compare as plain values."""
    return df.withColumn("keywords", F.array_join("keywords", ","))


def fold_sql(fires: str) -> str:
    """The upsert as a walk over each URL's hits, one row at a time."""
    return f"""with recursive {V.HITS},
ranked as (select *, row_number() over (partition by url order by checked_at, seq) as rn from hits),
walk as (
  select platform, url, rn, [keyword] as keywords, post_id, status, comment_count, created_at, checked_at, "view" from ranked where rn = 1
  union all
  select w.platform, w.url, r.rn,
    case when {fires} and not list_contains(w.keywords, r.keyword) then list_append(w.keywords, r.keyword) else w.keywords end,
    w.post_id,
    case when r.status in ('FAILED', 'BANNED') or {fires} then r.status else w.status end,
    case when {fires} then r.comment_count else w.comment_count end,
    case when {fires} then r.created_at else w.created_at end,
    case when r.status in ('FAILED', 'BANNED') or {fires} then r.checked_at else w.checked_at end,
    case when {fires} then r."view" else w."view" end
  from walk w join ranked r on r.url = w.url and r.rn = w.rn + 1)
select platform, url, array_to_string(keywords, ',') as keywords, post_id, status, comment_count, created_at, checked_at, "view"
from walk qualify row_number() over (partition by url order by rn desc) = 1"""


FIRES = """(r.status not in ('FAILED', 'BANNED') and (w."view" - r."view" > 100 or w.comment_count > r.comment_count
  or not list_contains(w.keywords, r.keyword)))"""
DOCUMENTED = """(r.status not in ('FAILED', 'BANNED') and (abs(w."view" - r."view") > 100 or w.comment_count <> r.comment_count
  or not list_contains(w.keywords, r.keyword)))"""


@query("tracking_upsert", fold_sql(FIRES))
def tracking_upsert(spark, sf):
    return as_text(T.tracking_upsert(None, A.hits(spark, sf)))


@query("tracking_upsert_documented", fold_sql(DOCUMENTED))
def tracking_upsert_documented(spark, sf):
    return as_text(T.tracking_upsert(None, A.hits(spark, sf), rule="documented"))


@query("tracking_upsert_incremental", fold_sql(FIRES))
def tracking_upsert_incremental(spark, sf):
    """Two rounds; the second starts from the stored result of the first."""
    hits = A.hits(spark, sf)
    first = hits.filter(F.col("checked_at") < ntz("2024-01-16 00:00:00"))
    rest = hits.filter(F.col("checked_at") >= ntz("2024-01-16 00:00:00"))
    return as_text(T.tracking_upsert(materialize(T.tracking_upsert(None, first), "tracking"), rest))


@query("stream_tracking", fold_sql(FIRES))
def run_stream_tracking(spark, sf):
    """Three deliveries of hits, each folded by its own micro-batch."""
    root = shared_path(spark, "hits")
    hits = A.hits(spark, sf)
    days = [None, "2024-01-11 00:00:00", "2024-01-21 00:00:00", None]
    for start, end in zip(days, days[1:]):
        part = hits
        if start:
            part = part.filter(F.col("checked_at") >= ntz(start))
        if end:
            part = part.filter(F.col("checked_at") < ntz(end))
        part.write.mode("append").option("parquet.block.size", str(store.ROW_GROUP)).parquet(f"{root}/in")
        incoming = spark.readStream.schema(HITS_SCHEMA).parquet(f"{root}/in")
        stream_tracking(incoming, f"{root}/tracking", f"{root}/checkpoint", buckets=16).awaitTermination()
    return as_text(read_tracking(spark, f"{root}/tracking"))


@query("tracking_lookup", V.with_views(V.TRACKING, f"""select h.platform, h.url, h.line, t.keywords as known_keywords, t.status as known_status,
  t.comment_count as known_comment_count, t.created_at as known_created_at, t.checked_at as known_checked_at, t."view" as known_view
from (select {V.site('l_orderkey')} as platform, '/o/' || (l_orderkey * 2) as url, l_linenumber as line from lineitem) h left join tracking t using (platform, url)"""))
def tracking_lookup(spark, sf):
    key = F.col("l_orderkey")
    hits = A.table(spark, sf, "lineitem").select(
        A.site(key).alias("platform"), F.concat(F.lit("/o/"), (key * 2).cast("string")).alias("url"), F.col("l_linenumber").alias("line")
    )
    found = T.tracking_lookup(hits, A.tracking(spark, sf))
    return found.withColumn("known_keywords", F.array_join("known_keywords", ","))


@query("status_transition", V.with_views(f"{V.TRACKING},\n{V.CHANGES}", """select t.platform, t.url, t.keywords, t.post_id, coalesce(c.status, t.status) as status, t.comment_count, t.created_at,
  coalesce(c.checked_at, t.checked_at) as checked_at, t."view"
from tracking t left join (select platform, url, arg_max(status, seq) as status, arg_max(checked_at, seq) filter (checked_at is not null) as checked_at
  from changes group by all) c using (platform, url)"""))
def status_transition(spark, sf):
    return as_text(T.status_transition(A.tracking(spark, sf), A.status_changes(spark, sf)))


@query("detail_refresh", V.with_views(V.TRACKING, f"""select t.platform, t.url, t.keywords, t.post_id, case when d.url is not null then 'UNCHANGED' else t.status end as status,
  coalesce(d.comment_count, t.comment_count) as comment_count, coalesce(d.created_at, t.created_at) as created_at, t.checked_at, coalesce(d."view", t."view") as "view"
from tracking t left join (select {V.site('k')} as platform, '/o/' || k as url, cast(floor(value) as int) % 50 as comment_count,
  cast(floor(value * 10) as int) as "view", ts as created_at from (select *, user_id * 10 + event_id % 10 as k from events) where event_type <> 'signup'
  qualify row_number() over (partition by k order by event_id desc) = 1) d using (platform, url)"""))
def detail_refresh(spark, sf):
    return as_text(T.detail_refresh(A.tracking(spark, sf), A.detail_figures(spark, sf)))


def returned(spark, sf):
    key = F.col("l_orderkey")
    return A.table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select(
        A.site(key).alias("platform"), F.concat(F.lit("/o/"), key.cast("string")).alias("url")
    )


@query("failed_write_rollback", V.with_views(V.TRACKING, """select platform, url, keywords, post_id,
  case when url in (select '/o/' || l_orderkey from lineitem where l_returnflag = 'R') then 'FAILED' else status end as status,
  comment_count, created_at, checked_at, "view" from tracking"""))
def failed_write_rollback(spark, sf):
    return as_text(T.failed_write_rollback(A.tracking(spark, sf), returned(spark, sf), "FAILED"))


READY = f"(status = 'CHANGED' or (status = 'BANNED' and timestamp '{A.NOW}' - checked_at > interval 1 hour))"
FIELDS = 'platform, url, keywords, post_id, {} as status, comment_count, created_at, checked_at, "view"'


def now():
    return ntz(A.NOW)


@query("claim_pending", V.with_views(V.TRACKING, f"select {FIELDS.format(chr(39) + 'CHANGED' + chr(39))} from tracking where {READY}"))
def claim_pending(spark, sf):
    return as_text(T.claim_pending(A.tracking(spark, sf), now())[0])


@query("claim_pending_state", V.with_views(V.TRACKING, f"select {FIELDS.format(f'case when {READY} then {chr(39)}UNCHANGED{chr(39)} else status end')} from tracking"))
def claim_pending_state(spark, sf):
    return as_text(T.claim_pending(A.tracking(spark, sf), now())[1])


CLAIMED = f"claimed as (select url from tracking where {READY} order by checked_at, platform, url limit 1000)"


@query("claim_pending_limit", V.with_views(f"{V.TRACKING},\n{CLAIMED}", f"select {FIELDS.format('case when url in (select url from claimed) then ' + chr(39) + 'UNCHANGED' + chr(39) + ' else status end')} from tracking"))
def claim_pending_limit(spark, sf):
    return as_text(T.claim_pending(A.tracking(spark, sf), now(), limit=1000)[1])


@query("claim_table", ORACLES["claim_pending_limit"])
def claim_table(spark, sf):
    """The same claim from the stored table: it reads waiting rows and writes the claimed ones."""
    path = shared_path(spark, "tracking")
    store.seed_table(A.tracking(spark, sf), path, buckets=16)
    store.claim_table(spark, path, now(), limit=1000)
    return as_text(store.read_table(spark, path))


PLATFORMS = [*A.SITES, "nowhere"]


def _backlog(name, rule, done):
    sql = "\nunion all\n".join(
        f"select '{p}' as platform, count(*) as backlog from tracking where platform = '{p}' and status not in ({done})" for p in PLATFORMS
    )
    query(name, V.with_views(V.TRACKING, sql))(lambda spark, sf: P.backlog_counts(A.tracking(spark, sf), PLATFORMS, rule))


_backlog("backlog_counts", "current", "'UNCHANGED', 'BANNED'")
_backlog("backlog_counts_older", "older", "'UNCHANGED'")

PLAN = f"""{V.TRACKING},
sources(source_pos, function_name, platform, flagged) as (values (0, 'bobae detail', 'bobaedream', false), (1, 'clien_detail', 'clien', true), (2, 'dc_detail', 'dcinside', false)),
counted as (select s.*, cast(ceil(count(t.url) / 40.0) as int) as needed from sources s
  left join tracking t on t.platform = s.platform and t.status not in ('UNCHANGED', 'BANNED') group by all),
called as (select *, case when flagged and needed > 0 and {{0}} then needed + 2 else needed end as calls from counted),
planned as (select *, unnest(range(0, case when flagged and {{0}} and calls > 0 then (select max(calls) from called)::bigint else calls::bigint end))::int as func_id from called)"""
PLAN_SELECT = f"""select func_id, source_pos, function_name,
  replace('invoke_lambda_' || function_name || case when func_id >= calls then '_all' else func_id::varchar end, ' ', '_') as task_id,
  func_id >= calls as filler, timestamp '{A.BATCH}' as checked_at from planned"""


def _detail_plan(name, flagged):
    @query(name, V.with_views(PLAN.format("true" if flagged else "false"), PLAN_SELECT))
    def run(spark, sf):
        backlog = P.backlog_counts(A.tracking(spark, sf), list(A.SITES))
        return P.detail_plan(backlog, DETAILS, 40, A.BATCH, flagged)


_detail_plan("detail_plan", "clien")
_detail_plan("detail_plan_plain", None)


@query("assign_shards", V.with_views(V.TRACKING, """select platform, url, (row_number() over (partition by platform order by md5(url), url) - 1) // 40 as shard
from tracking where status not in ('UNCHANGED', 'BANNED')"""))
def assign_shards(spark, sf):
    return P.assign_shards(A.tracking(spark, sf), 40)


KEYWORDS = "sets as (select distinct lang as name, source as keyword from documents)"


@query("keyword_lookup", V.with_views(KEYWORDS, "select keyword from sets where name = 'en'"))
def keyword_lookup(spark, sf):
    return P.keyword_lookup(A.keyword_set(spark, sf), "en")


def _search_plan(name, dated):
    calls = [("bobae search", False), ("clien_search", False), ("clien_search", True), ("dc_search", False)]
    parts = []
    for function, extra in calls:
        ranged = dated == "all" or (dated == "extra") == extra
        suffix = "'_all'" if extra else "'_' || keyword"
        start, end = ("date '2025-02-21'", "date '2025-02-25'") if ranged else ("cast(null as date)", "cast(null as date)")
        parts.append(
            f"select name, keyword, '{function}' as function_name, {str(extra).lower()} as extra, replace('invoke_lambda_{function}' || {suffix}, ' ', '_') as task_id, "
            f"timestamp '{A.BATCH}' as checked_at, {start} as start_date, {end} as end_date from sets"
        )

    @query(name, V.with_views(KEYWORDS, "\nunion all\n".join(parts)))
    def run(spark, sf):
        keywords = A.keyword_set(spark, sf).select("name", F.explode("keywords").alias("keyword"))
        return P.search_plan(keywords, FUNCTIONS, crawl_window(ntz(A.BATCH)), dated)


_search_plan("search_plan", "extra")
_search_plan("search_plan_base", "base")
_search_plan("search_plan_all", "all")


def _run_log(name, style, base):
    sql = f"""select ts as checked_at, 'no_keyword' as keywords_str, event_type as platform, 'landing' as bucket_name, path || '_posts.parquet' as posts_s3_path,
      path || '_comments.parquet' as comments_s3_path, timestamp '{A.NOW}' as created_at
      from (select *, 's3://landing/' || strftime(ts, '%Y-%m-%d') || '/' || hour(ts) || '/' || minute(ts) || '/' || {base} as path from events)"""

    @query(name, sql)
    def run(spark, sf):
        runs = A.table(spark, sf, "events").select(
            F.col("ts").alias("checked_at"), F.lit("no_keyword").alias("keywords_str"), F.col("event_type").alias("platform"),
            F.col("event_id").cast("string").alias("id"),
        )
        return P.run_log(runs, "landing", now(), style)


_run_log("run_log", "logged", "'no_keyword/' || event_type")
_run_log("run_log_actual", "actual", "event_id || '_' || event_type")
