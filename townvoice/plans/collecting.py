"""The collecting jobs: listings and details from site pages, landings with log and ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import collect, jobs
from ..functions.replies import NO_CONTENT, NO_TITLE
from ..functions.times import ntz
from ..operators import normalize as N
from ..session import shared_path
from ..sources import adapters as A
from ..sources import landing, ledger
from ..sources import tracking_table as store
from . import views as V
from .crawl import as_text
from .posts import CHECKED_AT, LANDED, LANDED_SUMMARY
from .registry import query
from .webpages import BODY, LINES, WS

LATER = "2025-02-24 14:00:03"
TENTH = "doc_id // 10"  # which site a document is a page of

SEARCHED = f"""{LINES},
listed as (
  select doc_id, pos, n_chars, time, doc_id * 100000 + pos as number, {V.site(TENTH)} as platform from lines),
found as (
  select *, case platform when 'dcinside' then 'https://gall.dcinside.com/board/view/?no=' || number
      when 'clien' then 'https://www.clien.net/service/' || number else 'https://www.bobaedream.co.kr/view?code=x&No=' || number end as url,
    case when platform <> 'bobaedream' then '' when pos % 4 = 0 then 'b' else 'm' end || number as post_id,
    case platform when 'bobaedream' then -999 else case when pos % 2 = 0 then pos else 0 end end as comment_count,
    case platform when 'bobaedream' then -999 when 'clien' then trunc(cast(n_chars || '.' || n_chars % 10 as double) * 1000) else n_chars end as "view",
    case platform when 'bobaedream' then date_trunc('day', time)::timestamp else time end as created_at
  from listed where platform <> 'bobaedream' or pos % 4 in (0, 3))"""


def with_site(pages):
    return pages.withColumn("platform", A.site(F.floor(F.col("page_id") / 10)))


def listings(spark, sf):
    """Listing pages of all sites: a document is a page, newest first."""
    pages = None
    for site in A.SITES:
        own = with_site(A.listing_html(spark, sf, site, "lang", "source")).filter(F.col("platform") == site)
        pages = own if pages is None else pages.unionByName(own)
    return pages.withColumn("page", (-F.col("page_id")).cast("int"))


@query("search_job", V.with_views(SEARCHED, f"""select platform, url, case when doc_id % 2 = 0 then lang || ',' || source else lang end as keywords, post_id, 'CHANGED' as status,
  comment_count::int as comment_count, created_at, case when doc_id % 2 = 0 then timestamp '{LATER}' else timestamp '{A.BATCH}' end as checked_at, "view"::int as "view"
from found join documents using (doc_id) where created_at <= {V.START} + interval 10 hours"""))
def search_job(spark, sf):
    """Two searches; the second meets half of the posts again under another keyword."""
    table, pages = shared_path(spark, "tracking"), listings(spark, sf)
    start, end = ntz("2024-01-01 00:00:00"), ntz("2024-01-01 10:00:00")
    keep = ["platform", "keyword", "page", "html"]
    collect.search(spark, pages.withColumnRenamed("lang", "keyword").select(*keep), table, CHECKED_AT, start, end)
    second = pages.filter(F.col("page") % 2 == 0).withColumnRenamed("source", "keyword").select(*keep)
    collect.search(spark, second, table, LATER.replace(" ", "T"), start, end)
    return as_text(store.read_table(spark, table))


KNOWN = f"""{LINES},
known as (
  select d.*, {V.site(TENTH)} as platform, '/d/' || doc_id as url, doc_id % 4 <> 0 as claimed,
    case when doc_id % 10 = 5 then 'banned' when doc_id % 10 = 7 then 'unseen'
      when doc_id % 10 = 9 then case when {V.site(TENTH)} = 'dcinside' then 'bare' else 'failed' end else 'whole' end as outcome
  from (select doc_id, lang, text, lines, n_chars, time from parts join (select doc_id, lang from documents) using (doc_id)) d),
post as (
  select doc_id, platform, url, lang, time, outcome, case when outcome = 'whole' then 't' || doc_id else '{NO_TITLE}' end as title,
    case when outcome = 'bare' then '{NO_CONTENT}' when platform = 'bobaedream' then regexp_replace({BODY}, '\\n{{2,}}', chr(10), 'g') else {BODY} end as content,
    case when outcome = 'whole' and (platform = 'bobaedream' or doc_id % 3 <> 0) then n_chars else 7 end as "view",
    case when outcome = 'whole' and platform = 'bobaedream' then time else {V.START} end as created_at,
    case when outcome = 'whole' then n_chars % 100 else 0 end as "like", case when platform = 'dcinside' then 0 end as dislike,
    case when outcome = 'whole' then len(lines) else 3 end as comment_count
  from known where claimed and outcome in ('whole', 'bare')),
remark as (
  select p.doc_id, p.platform, l.line, l.pos, l.time, p.created_at as of,
    row_number() over (partition by p.doc_id order by l.pos) = 1 as first
  from post p join lines l using (doc_id) where p.outcome = 'whole' and (p.platform <> 'clien' or l.pos % 5 <> 4))"""


def claimed_documents(spark, sf):
    key = F.col("doc_id")
    return A.table(spark, sf, "documents").select(
        A.site(F.floor(key / 10)).alias("platform"), F.concat(F.lit("/d/"), key.cast("string")).alias("url"), F.array("lang").alias("keywords"),
        key.cast("string").alias("post_id"), F.when(key % 4 == 0, "UNCHANGED").otherwise("CHANGED").alias("status"), F.lit(3).alias("comment_count"),
        ntz("2024-01-01 00:00:00").alias("created_at"), ntz("2025-02-24 12:00:00").alias("checked_at"), F.lit(7).alias("view"))


def details(spark, sf):
    """Detail pages of all sites: some refused, some not fetched, some not readable."""
    pages = A.every_detail_html(spark, sf, A.site(F.floor(F.col("doc_id") / 10)))
    last = F.col("page_id") % 10
    html = F.when(last == 5, F.lit(None)).when(last == 9, "<p>").otherwise(F.col("html"))
    return pages.filter(last != 7).select("platform", F.concat(F.lit("/d/"), F.col("page_id").cast("string")).alias("url"), html.alias("html"))


def labels(spark, sf):
    """A reply for every third document: the post's label and one comment's."""
    key = F.col("doc_id")
    reply = '{"게시글_감정": "negative", "댓글_분석": [{"내용": "-", "감정": "neutral"}]}'
    return A.table(spark, sf, "documents").filter(key % 3 == 1).select(
        A.site(F.floor(key / 10)).alias("platform"), key.cast("string").alias("post_id"), F.lit(reply).alias("reply"))


def collected(spark, sf):
    table, root = shared_path(spark, "tracking"), shared_path(spark, "landing")
    store.seed_table(claimed_documents(spark, sf), table, buckets=16)
    collect.detail(spark, details(spark, sf), table, root, CHECKED_AT, "d0", labels(spark, sf), log=f"{root}-log")
    return table, root


@query("detail_job", V.with_views(KNOWN, f"""select platform, title, doc_id::varchar as post_id, url, content, "view"::bigint as "view", created_at, "like"::bigint as "like",
  dislike::bigint as dislike, comment_count::bigint as comment_count, lang as keywords, case when doc_id % 3 = 1 then 'negative' end as sentiment,
  timestamp '{A.BATCH}' as checked_at, 'post' as kind from post
union all
select platform, null, doc_id::varchar, null, case when platform <> 'bobaedream' or pos % 6 <> 5 then trim(line, {WS}) end, null,
  case platform when 'dcinside' then of when 'clien' then time else case when pos % 6 <> 5 then time end end,
  case platform when 'clien' then case when pos % 2 = 0 then pos else 0 end when 'bobaedream' then case when pos % 6 <> 5 then pos end end,
  case when platform = 'bobaedream' and pos % 6 <> 5 then 1 end, null, null,
  case when doc_id % 3 = 1 and first then 'neutral' end, timestamp '{A.BATCH}', 'comment' from remark"""))
def detail_job(spark, sf):
    return landing.scan_batch(spark, collected(spark, sf)[1], CHECKED_AT)


@query("detail_job_state", V.with_views(KNOWN, f"""select k.platform, k.url, k.lang as keywords, k.doc_id::varchar as post_id,
  case when not claimed then 'UNCHANGED' when k.outcome = 'banned' then 'BANNED' when k.outcome = 'unseen' then 'CHANGED' when k.outcome = 'failed' then 'FAILED' else 'UNCHANGED' end as status,
  coalesce(p.comment_count, 3)::int as comment_count, coalesce(p.created_at, {V.START}) as created_at,
  case when claimed and k.outcome in ('banned', 'failed') then timestamp '{A.BATCH}' else timestamp '2025-02-24 12:00:00' end as checked_at, coalesce(p."view", 7)::int as "view"
from known k left join post p using (doc_id)"""))
def detail_job_state(spark, sf):
    return as_text(store.read_table(spark, collected(spark, sf)[0]))


@query("land_batch", """select platform, case when platform = 'dcinside' then 0 else count(*) end as posts,
  case when platform = 'dcinside' then 0 else sum(len(string_split(text, chr(10))))::bigint end as comments, case when platform = 'dcinside' then 0 else 1 end as logged,
  case when platform = 'bobaedream' then count(*) else 0 end as changed, case when platform = 'dcinside' then count(*) else 0 end as failed,
  case when platform = 'clien' then count(*) else 0 end as unchanged
from (select *, ['bobaedream', 'clien', 'dcinside'][doc_id % 3 + 1] as platform from documents) group by platform""")
def land_batch(spark, sf):
    """Two of three sites fail while their comments are written; one of them lands again, twice."""
    root, table = shared_path(spark, "landing"), shared_path(spark, "tracking")
    key = F.col("post_id").cast("bigint")
    nested = A.nested_posts(spark, sf).withColumn("platform", A.site(key))
    claimed = nested.select(
        "platform", "url", F.array().cast("array<string>").alias("keywords"), "post_id", F.lit("UNCHANGED").alias("status"), F.lit(0).alias("comment_count"),
        "created_at", "created_at", F.lit(0).alias("view")).toDF(*store.NAMES)
    store.seed_table(claimed, table, buckets=16)
    lost = F.transform("comment", lambda c: c.withField("content", F.raise_error(F.lit("disk full")).cast("string")))
    for site, tries in (("clien", "+"), ("dcinside", "-"), ("bobaedream", "-++")):
        own = nested.filter(F.col("platform") == site)
        for attempt in tries:
            try:
                collect.land_batch(spark, own if attempt == "+" else own.withColumn("comment", lost), root, CHECKED_AT, site, "d0", table, f"{root}-log")
            except Exception as problem:  # noqa: BLE001 - the failure that is asked for
                if attempt == "+" or "disk full" not in str(problem):
                    raise
    landed = landing.scan_batch(spark, root, CHECKED_AT).groupBy("platform").agg(
        F.count_if(F.col("kind") == "post").alias("posts"), F.count_if(F.col("kind") == "comment").alias("comments"))
    logged = spark.read.parquet(f"{root}-log").groupBy("platform").agg(F.count(F.lit(1)).alias("logged"))
    states = store.read_table(spark, table).groupBy("platform").agg(
        *[F.count_if(F.col("status") == name.upper()).alias(name) for name in ("changed", "failed", "unchanged")])
    every = states.join(landed, "platform", "left").join(logged, "platform", "left").fillna(0)
    return every.select("platform", "posts", "comments", "logged", "changed", "failed", "unchanged")


EMPTY = "2025-02-24T14:10:07"


@query("file_ledger", V.with_views(LANDED, """select 'd0_all' as name, count(*) as rows, 'read' as outcome from landed
union all select 'd1_all', 0, 'empty' union all select 'broken', 0, 'unreadable' union all select 'd2_all', 0, 'hidden'"""))
def file_ledger(spark, sf):
    """A batch of a landing, an empty one, one that failed, and files that are no Parquet."""
    root = shared_path(spark, "landing")
    folder = f"{root}/{landing.batch_dir(CHECKED_AT)}"
    nested = N.keep_parsed(A.nested_posts(spark, sf))
    landing.land_nested(nested, root, CHECKED_AT, None, "d0")
    landing.land_nested(nested.filter("post_id is null"), root, CHECKED_AT, None, "d1")
    nested.select("title").na.fill("").write.text(f"{folder}/broken_posts.parquet")
    try:
        landing.land_nested(nested.withColumn("view", F.lit("many")), root, CHECKED_AT, None, "d2")
    except Exception as problem:  # noqa: BLE001 - the failure that is asked for
        if "not an integer" not in str(problem):
            raise
    files = ledger.file_ledger(spark, folder)
    # a task without rows leaves an empty file beside the others
    order = F.element_at(F.create_map(*[F.lit(x) for pair in (("read", 3), ("unreadable", 2), ("hidden", 1), ("empty", 0)) for x in pair]), F.col("outcome"))
    return files.groupBy("name").agg(F.sum("rows").cast("bigint").alias("rows"), F.max_by("outcome", order).alias("outcome")).unionByName(
        landing.landings(spark, folder).filter("state = 'begun'").join(files, "name", "left_anti").select("name", F.lit(0).cast("bigint").alias("rows"), F.lit("hidden").alias("outcome")))


@query("backfill_empty", V.with_views(LANDED, f"""{LANDED_SUMMARY} union all select timestamp '2025-02-24 14:10:07', null, 0, null, null, null{', null' * len(A.LATIN_LEXICON)}"""))
def backfill_empty(spark, sf):
    """A batch with rows and one without."""
    root = shared_path(spark, "landing")
    nested = N.keep_parsed(A.nested_posts(spark, sf))
    landing.land_nested(nested, root, CHECKED_AT, None, "d0")
    landing.land_nested(nested.filter("post_id is null"), root, EMPTY, None, "d0")
    return jobs.backfill(spark, root, A.LATIN_LEXICON)


@query("empty_batch_summary", f"""select timestamp '2025-02-24 14:10:07' as checked_at, null::bigint as total_views, 0::bigint as total_posts_comments,
  null::bigint as positive, null::bigint as neutral, null::bigint as negative, {', '.join(f'null::bigint as {name}_total_count' for _, _, name in A.LATIN_LEXICON)}""")
def empty_batch_summary(spark, sf):
    """The batch whose landings have no rows goes through the whole transform."""
    root = shared_path(spark, "landing")
    landing.land_nested(A.nested_posts(spark, sf).filter("post_id is null"), root, EMPTY, None, "d0")
    return spark.read.parquet(jobs.transform_batch(spark, root, shared_path(spark, "output"), EMPTY, A.LATIN_LEXICON)[1])


