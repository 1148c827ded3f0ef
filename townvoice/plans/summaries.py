"""Summary, history and dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..lexicon import DEFAULT_LEXICON, of_category
from ..operators import rollup as R
from ..operators import summary as S
from ..session import materialize
from ..sources import adapters as A
from . import views as V
from .registry import query

ALL_TERMS = DEFAULT_LEXICON + A.LATIN_LEXICON
FIGURES = ["total_views", "total_posts_comments", "positive", "neutral", "negative"]


def merged(spark, sf, many=False):
    return S.union_posts_comments(A.posts(spark, sf, many), A.comments(spark, sf, many))


def flagged(spark, sf, lexicon, many=False, labelled=True):
    """Posts and comments with term flags for their content; a join moves the flags' bits, no texts."""

    def pack(rows):
        return S.packed_flags(rows, lexicon).drop("content")

    posts = S.unpacked_flags(A.posts(spark, sf, many, pack, labelled), lexicon)
    return S.union_posts_comments(posts, S.keyword_flags(A.comments(spark, sf, many), lexicon).drop("content"))


def flags_alone(spark, sf, lexicon):
    """The same for figures that need no label, without the join."""
    return flagged(spark, sf, lexicon, labelled=False)


def history(spark, sf):
    return S.summary_history(flagged(spark, sf, A.LATIN_LEXICON, True), A.LATIN_LEXICON)


def stored_history(spark, sf):
    """The summary as a stored table, as dashboards read it."""
    return materialize(history(spark, sf), "summary")


HISTORY_SQL = f"{V.merged(True)},\nhistory as (select checked_at, {V.BASE_METRICS}, {V.totals(A.LATIN_LEXICON)} from merged group by checked_at)"


@query("batch_summary", V.with_views(V.merged(), f"select timestamp '{A.BATCH}' as checked_at, {V.BASE_METRICS}, {V.totals(DEFAULT_LEXICON)} from merged"))
def batch_summary(spark, sf):
    return S.batch_summary(flagged(spark, sf, DEFAULT_LEXICON), A.BATCH)


@query("batch_summary_latin", V.with_views(V.merged(), f"select timestamp '{A.BATCH}' as checked_at, {V.BASE_METRICS}, {V.totals(A.LATIN_LEXICON)} from merged"))
def batch_summary_latin(spark, sf):
    return S.batch_summary(flagged(spark, sf, A.LATIN_LEXICON), A.BATCH, A.LATIN_LEXICON)


@query("sentiment_summary", V.with_views(V.merged(), f"select {V.BASE_METRICS} from merged"))
def sentiment_summary(spark, sf):
    return S.sentiment_summary(merged(spark, sf))


@query("stamp_checked_at", V.with_views(V.merged(), f"select timestamp '{A.BATCH}' as checked_at, {V.BASE_METRICS} from merged"))
def stamp_checked_at(spark, sf):
    return S.stamp_checked_at(S.sentiment_summary(merged(spark, sf)), A.BATCH)


@query("sentiment_summary_v1", V.with_views(V.merged(), f"""select timestamp '{A.BATCH}' as checked_at,
  cast(sum("view") as int) as total_views, cast(count(*) as int) as total_posts_comments,
  cast(count(*) filter (sentiment = 'positive') as int) as positive,
  cast(count(*) filter (sentiment = 'neutral') as int) as neutral,
  cast(count(*) filter (sentiment = 'negative') as int) as negative from merged"""))
def sentiment_summary_v1(spark, sf):
    return S.sentiment_summary_v1(A.posts(spark, sf), A.comments(spark, sf), A.BATCH)


FLAGS = ", ".join(f"{V.flag(term)} as {name}_count" for _, term, name in ALL_TERMS)


@query("keyword_flags", V.with_views(V.merged(), f"select platform, post_id, length(content) as n, {FLAGS} from merged"))
def keyword_flags(spark, sf):
    def measure(rows):
        length = F.length("content").cast("bigint").alias("n")
        return S.keyword_flags(rows.select("*", length), ALL_TERMS).drop("content")

    rows = S.union_posts_comments(A.posts(spark, sf, prepare=measure, labelled=False), measure(A.comments(spark, sf)))
    return rows.select("platform", "post_id", "n", *[f"{name}_count" for _, _, name in ALL_TERMS])


def _category(name, operator, category):
    terms = of_category(ALL_TERMS, category)
    sql = V.with_views(V.merged(), f"select {V.totals(terms)} from merged")
    query(name, sql)(lambda spark, sf: operator(flags_alone(spark, sf, terms), ALL_TERMS))


_category("accident_totals", S.accident_totals, "accident")
_category("brand_totals", S.brand_totals, "brand")
_category("model_totals", S.model_totals, "model")
_category("ev_issue_totals", S.ev_issue_totals, "ev_issue")


@query("summary_history", V.with_views(HISTORY_SQL, "select * from history"))
def summary_history(spark, sf):
    return history(spark, sf)


LONG = "\nunion all\n".join(
    f"select '{category}' as category, '{name}' as name, coalesce(cast(sum({V.flag(term)}) as bigint), 0) as total from merged"
    for category, term, name in ALL_TERMS
)


@query("keyword_long", V.with_views(V.merged(), LONG))
def keyword_long(spark, sf):
    return S.keyword_long(flags_alone(spark, sf, ALL_TERMS), ALL_TERMS)


def _rollup(name, unit):
    figures = [*FIGURES, *[f"{n}_total_count" for _, _, n in A.LATIN_LEXICON]]
    sums = ", ".join(f"cast(sum({f}) as bigint) as {f}" for f in figures)
    sql = f"select cast(date_trunc('{unit}', checked_at) as timestamp) as period, count(*) as batches, {sums} from history group by 1"
    query(name, V.with_views(HISTORY_SQL, sql))(lambda spark, sf: R.summary_rollup(history(spark, sf), unit))


_rollup("summary_rollup", "hour")
_rollup("summary_rollup_day", "day")

TREND_NAMES = [name for category, _, name in A.LATIN_LEXICON if category in ("brand", "model")]
TREND = "\nunion all\n".join(
    f"select checked_at, '{n}' as name, {n}_total_count as total, {n}_total_count - lag({n}_total_count) over (order by checked_at) as change from history"
    for n in TREND_NAMES
)


@query("mention_trend", V.with_views(HISTORY_SQL, TREND))
def mention_trend(spark, sf):
    return R.mention_trend(stored_history(spark, sf), TREND_NAMES)


NEGATIVE = """trend as (select checked_at, total_posts_comments, negative,
  cast(negative as double) / total_posts_comments as negative_share,
  negative - lag(negative) over (order by checked_at) as change from history)"""


@query("negative_trend", V.with_views(f"{HISTORY_SQL},\n{NEGATIVE}", "select * from trend"))
def negative_trend(spark, sf):
    return R.negative_trend(stored_history(spark, sf))


@query("negative_alert", V.with_views(f"{HISTORY_SQL},\n{NEGATIVE}", "select * from trend where total_posts_comments >= 5 and negative_share >= 0.4"))
def negative_alert(spark, sf):
    return R.negative_alert(stored_history(spark, sf), min_rows=5, threshold=0.4)


POST_COLUMNS = 'platform, title, post_id, url, content, "view", created_at, "like", dislike, comment_count, keywords, sentiment, checked_at'


@query("project_posts", V.with_views(V.posts(), f"select {POST_COLUMNS} from posts"))
def project_posts(spark, sf):
    return S.project_posts(A.posts(spark, sf).withColumn("extra", F.lit(1)))


@query("align_columns", V.with_views(V.merged(), f"select {', '.join(sorted(POST_COLUMNS.split(', '), key=lambda c: c.strip(chr(34))))} from merged"))
def align_columns(spark, sf):
    posts, comments = S.align_columns(A.posts(spark, sf), A.comments(spark, sf))
    return posts.union(comments)


@query("union_posts_comments", V.with_views(V.merged(), f"select {POST_COLUMNS} from merged"))
def union_posts_comments(spark, sf):
    return merged(spark, sf)


@query("dedupe_posts", V.with_views(V.posts(), "select distinct platform, post_id, checked_at from posts"))
def dedupe_posts(spark, sf):
    posts = A.posts(spark, sf)
    return S.dedupe(S.union_posts_comments(posts, posts)).select("platform", "post_id", "checked_at")


LARGE = [("word", term, f"t{i}") for i, term in enumerate(
    a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in ("a", "e", "i", "o", "u", "n", "r", "s", "t", "th", "st", "on"))]
PAIRS = ", ".join(f"('{term}', '{name}')" for _, term, name in LARGE)


@query("keyword_long_large", V.with_views(V.merged(), f"""select 'word' as category, name, (select count(*) from merged where contains(content, term)) as total
from (values {PAIRS}) l(term, name)"""))
def keyword_long_large(spark, sf):
    """Hundreds of terms, found in one walk over each text."""
    return S.keyword_long(merged(spark, sf), LARGE)
