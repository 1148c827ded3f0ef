"""Column functions applied to text and times derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import replies as R
from ..functions import text as X
from ..functions import times as D
from ..operators.normalize import salt_post_id as salt
from ..operators.sentiment import attach_sentiment as attach
from ..operators.sentiment import sentiment_requests
from ..session import shared_path
from ..sources import adapters as A
from ..sources.sinks import store_bucketed
from . import views as V
from .registry import ORACLES, query

INTEGER = r"[+-]?\d+"
SUBJECT = "신차"


def choose(key, *values):
    """The value at position ``key % len(values)``."""
    out = F.when(key % len(values) == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        out = out.when(key % len(values) == i, value)
    return out


def choose_sql(key, *values):
    cases = " ".join(f"when {i} then {value}" for i, value in enumerate(values))
    return f"case {key} % {len(values)} {cases} end"


def documents(spark, sf):
    return A.table(spark, sf, "documents")


def key():
    return F.col("doc_id")


def size():
    return F.col("n_chars")


def size_text():
    return size().cast("string")


def number_text():
    return choose(
        key(), F.col("lang"), size_text(), F.concat(F.lit(" "), size_text(), F.lit("\n")),
        F.format_number(size(), 0), F.concat(size_text(), F.lit(".5")), F.concat(F.lit("-"), size_text()),
    )


NUMBER_SQL = choose_sql("doc_id", "lang", "n_chars::varchar", "' ' || n_chars || chr(10)", "format('{:,}', n_chars)", "n_chars || '.5'", "'-' || n_chars")


@query("lenient_int", f"""select doc_id, case when regexp_full_match(trim(x, E' \\n'), '{INTEGER}') then cast(trim(x, E' \\n') as bigint) end as number
from (select doc_id, {NUMBER_SQL} as x from documents)""")
def lenient_int(spark, sf):
    return documents(spark, sf).select("doc_id", X.lenient_int(number_text()).alias("number"))


@query("strict_int", "select doc_id, n_chars as number from documents")
def strict_int(spark, sf):
    return documents(spark, sf).select("doc_id", X.strict_int(F.concat(F.lit(" "), size_text())).alias("number"))


COUNT_SQL = choose_sql("doc_id", "'조회 ' || format('{:,}', n_chars)", "'[' || n_chars || ']'", "'댓글 ' || n_chars", "'추천 ' || n_chars", "null", "lang")


@query("parse_count", f"""select doc_id, case when x is null then 0 when regexp_full_match(y, '{INTEGER}') then cast(y as bigint) end as number
from (select *, regexp_replace(x, '조회 |댓글 |추천 |반대 |[\\[\\],]', '', 'g') as y from (select doc_id, {COUNT_SQL} as x from documents))""")
def parse_count(spark, sf):
    text = choose(
        key(), F.concat(F.lit("조회 "), F.format_number(size(), 0)), F.concat(F.lit("["), size_text(), F.lit("]")),
        F.concat(F.lit("댓글 "), size_text()), F.concat(F.lit("추천 "), size_text()), F.lit(None), F.col("lang"),
    )
    return documents(spark, sf).select("doc_id", X.parse_count(text).alias("number"))


SI_SQL = choose_sql("doc_id", "n_chars::varchar", "n_chars // 10 || '.' || n_chars % 10 || ' k'", "n_chars || ' M'", "n_chars || ' x'", "lang")


@query("parse_si_count", f"""select doc_id, cast(trunc(try_cast(string_split(x, ' ')[1] as double) *
  case string_split(x, ' ')[2] when 'k' then 1000 when 'M' then 1000000 when 'G' then 1000000000 else case when contains(x, ' ') then null else 1 end end) as bigint) as number
from (select doc_id, {SI_SQL} as x from documents)""")
def parse_si_count(spark, sf):
    tenths = F.concat(F.floor(size() / 10).cast("string"), F.lit("."), (size() % 10).cast("string"), F.lit(" k"))
    text = choose(key(), size_text(), tenths, F.concat(size_text(), F.lit(" M")), F.concat(size_text(), F.lit(" x")), F.col("lang"))
    return documents(spark, sf).select("doc_id", X.parse_si_count(text).alias("number"))


def time():
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + A.minutes(key() * 7)


TIME_SQL = f"({V.START} + doc_id * 7 * interval 1 minute)"


@query("parse_community_ts", f"""select doc_id,
  case when doc_id % 9 <> 0 then {TIME_SQL} end as seconds,
  case when doc_id % 9 <> 0 then date_trunc('day', {TIME_SQL})::timestamp end as day,
  case when doc_id % 9 <> 0 then {TIME_SQL} end as weekday,
  case when doc_id % 9 <> 0 then {TIME_SQL} end as minutes
from documents""")
def parse_community_ts(spark, sf):
    def text(style, before="", after=""):
        return F.when(key() % 9 == 0, F.col("source")).otherwise(F.concat(F.lit(before), F.date_format("t", style), F.lit(after)))

    weekday = F.when(key() % 9 == 0, F.col("lang")).otherwise(
        F.concat(F.date_format("t", "yyyy.MM.dd"), F.lit("&nbsp;(금)  "), F.date_format("t", "HH:mm"))
    )
    return documents(spark, sf).withColumn("t", time()).select(
        "doc_id",
        D.parse_community_ts(text("yyyy-MM-dd HH:mm:ss", "작성 ", " / 수정일: 2030-01-01 00:00:00"), "seconds").alias("seconds"),
        D.parse_community_ts(text("yy. MM. dd"), "date").alias("day"),
        D.parse_community_ts(weekday, "weekday").alias("weekday"),
        D.parse_community_ts(text("yy.MM.dd HH:mm"), "minutes").alias("minutes"),
    )


@query("clean_date_text", f"select doc_id, strftime({TIME_SQL}, '%Y.%m.%d %H:%M') as cleaned from documents")
def clean_date_text(spark, sf):
    raw = F.concat(F.lit(" "), F.date_format(time(), "yyyy.MM.dd"), F.lit("&nbsp;(일)\n "), F.date_format(time(), "HH:mm"), F.lit(" "))
    return documents(spark, sf).select("doc_id", D.clean_date_text(raw).alias("cleaned"))


@query("clean_content", """select doc_id, regexp_replace(replace(trim(x, E' \\n\\t\\r' || chr(160)), chr(160), ' '), '\\n{2,}', chr(10), 'g') as cleaned
from (select doc_id, E'\\n ' || chr(160) || replace(replace(text, ', ', ',' || chr(160)), '.', E'.\\n\\n') || E' \\t\\n' as x from documents)""")
def clean_content(spark, sf):
    raw = F.replace(F.replace("text", F.lit(", "), F.lit(",\xa0")), F.lit("."), F.lit(".\n\n"))
    return documents(spark, sf).select("doc_id", X.clean_content(F.concat(F.lit("\n \xa0"), raw, F.lit(" \t\n"))).alias("cleaned"))


@query("join_keywords", V.with_views(V.NESTED_EDGES, "select doc_id, keywords from nested"))
def join_keywords(spark, sf):
    return A.nested_posts(spark, sf, edges=True).select(F.col("post_id").cast("bigint").alias("doc_id"), X.join_keywords(F.col("keywords")).alias("keywords"))


@query("unique_keywords", "select doc_id, array_to_string(list_sort(list_distinct(string_split(text, ' '))), ' ') as words, len(list_distinct(string_split(text, ' '))) as n from documents")
def unique_keywords(spark, sf):
    words = X.unique_keywords(F.split("text", " "))
    return documents(spark, sf).select(
        "doc_id", F.array_join(F.array_sort(words), " ").alias("words"), F.size(words).cast("bigint").alias("n")
    )


@query("batch_path", "select o_orderkey, strftime(t, '%Y-%m-%d') || '/' || hour(t) || '/' || minute(t) as path from (select o_orderkey, o_orderdate + o_orderkey * interval 1 minute as t from orders)")
def batch_path(spark, sf):
    started = F.col("o_orderdate") + A.minutes(F.col("o_orderkey"))
    text = F.translate(started.cast("string"), " ", "T")
    return A.table(spark, sf, "orders").select("o_orderkey", D.batch_path(D.batch_ts(text)).alias("path"))


BOARDS = [*X.BOARD_LETTERS, "news", "없는 게시판"]
LETTERS = ", ".join(f"('{board}', '{letter}')" for board, letter in X.BOARD_LETTERS.items())
BOARD_SQL = "[" + ", ".join(f"'{board}'" for board in BOARDS) + f"][doc_id % {len(BOARDS)} + 1]"


def with_board(spark, sf):
    boards = F.array(*[F.lit(board) for board in BOARDS])
    return documents(spark, sf).select(
        "doc_id", key().cast("string").alias("post_id"), F.element_at(boards, (key() % len(BOARDS) + 1).cast("int")).alias("category")
    )


@query("salt_post_id", f"select doc_id, category, letter || doc_id as post_id from (select doc_id, {BOARD_SQL} as category from documents) join (values {LETTERS}) t(category, letter) using (category)")
def salt_post_id(spark, sf):
    return salt(with_board(spark, sf)).select("doc_id", "category", "post_id")


@query("category_filter", f"select doc_id, {BOARD_SQL} as category from documents where {BOARD_SQL} <> '내차사진' and not contains({BOARD_SQL}, '유머')")
def category_filter(spark, sf):
    from ..operators.listing import category_filter as keep

    return keep(with_board(spark, sf)).select("doc_id", "category")


@query("post_id_from_url", "select event_id, 'https://www.bobaedream.co.kr/view?code=' || event_type || '&No=' || event_id as url, cast(event_id as varchar) as post_id from events")
def post_id_from_url(spark, sf):
    path = F.concat(F.lit("/view?code="), "event_type", F.lit("&No="), F.col("event_id").cast("string"))
    return A.table(spark, sf, "events").select(
        "event_id", X.absolute_url("https://www.bobaedream.co.kr", path).alias("url"), X.post_id_from_url(path).alias("post_id")
    )


@query("to_kst", "select event_id, case when event_type = 'error' then timestamp '2025-02-24 00:00:00' else ts end + interval 9 hours as kst from events")
def to_kst(spark, sf):
    utc = F.when(F.col("event_type") != "error", F.col("ts"))
    return A.table(spark, sf, "events").select("event_id", D.to_kst(utc, D.ntz("2025-02-24 00:00:00")).alias("kst"))


@query("crawl_window", "select event_id, ts as checked_at, cast(ts as date) - 3 as start_date, cast(ts as date) + 1 as end_date from events")
def crawl_window(spark, sf):
    return A.table(spark, sf, "events").select("event_id", *D.crawl_window(F.col("ts")))


@query("strip_json_fence", """select doc_id, regexp_replace(trim(x, E' \\n\\t'), '```json\\s*([\\s\\S]*?)\\s*```', '\\1', 'g') as body
from (select doc_id, case doc_id % 2 when 0 then text else E' ```json\\n' || text || E'\\n```\\n' end as x from documents)""")
def strip_json_fence(spark, sf):
    fenced = choose(key(), F.col("text"), F.concat(F.lit(" ```json\n"), "text", F.lit("\n```\n")))
    return documents(spark, sf).select("doc_id", R.strip_json_fence(fenced).alias("body"))


# What the replies of the adapter must yield, worked out from the documents.
LABEL = "['positive', 'neutral', 'negative'][{} % 3 + 1]"
USABLE = "doc_id % 11 <> 0 and doc_id % 13 <> 0"
REPLIED = f"""replied as (
  select doc_id, case when {USABLE} then case when doc_id % 10 = 3 then 'neutral' else {LABEL.format('doc_id')} end end as label,
    case when {USABLE} then list_transform(
      case doc_id % 9 when 4 then string_split(text, chr(10))[1:1] when 5 then list_concat(string_split(text, chr(10)), string_split(text, chr(10)))
      else string_split(text, chr(10)) end, lambda l: {LABEL.format('length(l)')}) end as labels
  from documents)"""


@query("parse_sentiment_json", V.with_views(REPLIED, "select cast(doc_id as varchar) as post_id, label, array_to_string(labels, ',') as labels from replied"))
def parse_sentiment_json(spark, sf):
    replies = A.replies(spark, sf).withColumn("r", R.parse_sentiment_json(F.col("reply")))
    return replies.select("post_id", F.col("r.label").alias("label"), F.array_join("r.comments", ",").alias("labels"))


@query("attach_sentiment", V.with_views(f"{V.NESTED},\n{REPLIED}", """
select post_id, null::bigint as pos, label as sentiment from nested join replied using (doc_id)
union all
select post_id, pos, labels[pos + 1] from lines join replied using (doc_id)"""))
def attach_sentiment(spark, sf):
    return labels_of(attach(A.nested_posts(spark, sf), A.replies(spark, sf)))


@query("attach_sentiment_bucketed", ORACLES["attach_sentiment"])
def attach_sentiment_bucketed(spark, sf):
    """Posts and replies stored by the same buckets: the join moves neither."""
    place, keys = shared_path(spark, "labelled"), ["platform", "post_id"]
    name = f"p{place.rsplit('-', 1)[1]}"
    nested = store_bucketed(A.nested_posts(spark, sf), f"{name}_posts", f"{place}/posts", keys, 8)
    replies = store_bucketed(A.replies(spark, sf), f"{name}_replies", f"{place}/replies", keys, 8)
    return labels_of(attach(nested, replies))


def labels_of(labelled):
    none = F.lit(None).cast("bigint")
    post = F.array(F.struct(none.alias("pos"), "sentiment"))
    comment = F.transform("comment", lambda c, i: F.struct(i.cast("bigint").alias("pos"), c["sentiment"].alias("sentiment")))
    return labelled.select("post_id", F.inline(F.concat(post, F.coalesce(comment, F.array()))))


TASK_SQL = (
    f'{SUBJECT}에 대한 게시글과 각 댓글의 감정을 positive, negative, neutral 중 하나로 판단하고 '
    '{"게시글_감정": 감정, "댓글_분석": [{"내용": 댓글, "감정": 감정}]} 형식의 JSON으로만 답하세요.'
)


@query("sentiment_prompt", V.with_views(V.NESTED_EDGES, f"""select post_id, '{TASK_SQL}' || E'\\n제목: ' || coalesce(title, '제목 없음') || E'\\n본문: ' ||
  coalesce(content, '본문 없음') || E'\\n댓글:\\n' || coalesce(array_to_string(list_transform(lines, lambda l: '- ' || l), chr(10)), '') as prompt from nested"""))
def sentiment_prompt(spark, sf):
    return sentiment_requests(A.nested_posts(spark, sf, edges=True), SUBJECT, "post_id")
