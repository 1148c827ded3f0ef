"""Page extraction queries: site pages are written from documents and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import adapters as A
from ..sources import pages as G
from . import views as V
from .registry import query

WS = "E' \\n\\t\\r' || chr(160)"
LINES = f"""parts as (select doc_id, text, n_chars, string_split(text, chr(10)) as lines, {V.START} + doc_id * interval 1 minute as time from documents),
lines as (select doc_id, n_chars, time, unnest(lines) as line, generate_subscripts(lines, 1) - 1 as pos from parts)"""
BOARD = "['자유게시판', '내차사진', 'news', '국산차게시판'][pos % 4 + 1]"


def _listing(site, fields):
    sql = V.with_views(LINES, f"select doc_id as page_id, pos::int as pos, trim(line, {WS}) as title, {fields} from lines")

    @query(f"parse_listing_{site}", sql)
    def run(spark, sf):
        return G.parse_listing(A.listing_html(spark, sf, site), site)


NUMBER = "(doc_id * 100000 + pos)"
_listing("dcinside", f"""'https://gall.dcinside.com/board/view/?no=' || {NUMBER} as url, {NUMBER}::varchar as post_id, null::varchar as category, null::varchar as writer,
  case when pos % 2 = 0 then pos else 0 end::int as comment_count, n_chars::int as "view", time as created_at, 'CHANGED' as status""")
_listing("clien", f"""'https://www.clien.net/service/' || {NUMBER} as url, {NUMBER}::varchar as post_id, null::varchar as category, null::varchar as writer,
  case when pos % 2 = 0 then pos else 0 end::int as comment_count, trunc(cast(n_chars || '.' || n_chars % 10 as double) * 1000)::int as "view", time as created_at, 'CHANGED' as status""")
_listing("bobaedream", f"""'https://www.bobaedream.co.kr/view?code=x&No=' || {NUMBER} as url, case pos % 4 when 0 then 'b' when 1 then 'l' else 'm' end || {NUMBER} as post_id,
  {BOARD} as category, 'w' as writer, -999 as comment_count, -999 as "view", date_trunc('day', time)::timestamp as created_at, 'CHANGED' as status""")
from .registry import ORACLES  # noqa: E402

ORACLES["parse_listing_bobaedream"] += " where pos % 4 <> 2"  # the board "news" has no letter

STRIPPED = f"list_filter(list_transform(string_split(text, chr(0)), lambda l: trim(l, {WS})), lambda l: l <> '')"


FIELDS = ["title", "content", "view", "like", "dislike", "comment_count", "created_at"]


def _detail(site, post, comment, keep="true"):
    sql = V.with_views(LINES, f"""select doc_id as page_id, null::bigint as pos, {post} from parts
      union all select doc_id, pos, {comment} from lines where {keep}""")

    @query(f"parse_detail_{site}", sql)
    def run(spark, sf):
        # The post and its comments as rows, from one pass over the pages.
        posts = G.parse_detail(A.detail_html(spark, sf, site), site)
        absent = {"title": "string", "view": "bigint", "comment_count": "bigint"}
        head = F.struct(F.lit(None).cast("bigint").alias("pos"), *FIELDS)
        rows = F.transform("comment", lambda c, n: F.struct(
            n.cast("bigint").alias("pos"),
            *[F.lit(None).cast(absent[name]).alias(name) if name in absent else c[name].alias(name) for name in FIELDS],
        ))
        return posts.select("page_id", F.inline(F.concat(F.array(head), rows)))


TITLE = "'t' || doc_id as title"
VIEWS = "case when doc_id % 3 <> 0 then n_chars end"
BODY = f"trim(text, {WS})"
_detail(
    "dcinside",
    f'{TITLE}, {BODY} as content, {VIEWS} as "view", n_chars % 100 as "like", 0::bigint as dislike, len(lines)::bigint as comment_count, null::timestamp as created_at',
    f"null, trim(line, {WS}), null, null, null, null, null",
)
_detail(
    "clien",
    f'{TITLE}, {BODY} as content, {VIEWS} as "view", n_chars % 100 as "like", null::bigint as dislike, len(lines)::bigint as comment_count, null::timestamp as created_at',
    f"null, trim(line, {WS}), null, case when pos % 2 = 0 then pos else 0 end, null, null, time",
    "pos % 5 <> 4",
)
# Positions are counted among the comments kept: the fifth of every five is gone.
ORACLES["parse_detail_clien"] = ORACLES["parse_detail_clien"].replace("union all select doc_id, pos,", "union all select doc_id, pos - pos // 5,")
_detail(
    "bobaedream",
    f"""{TITLE}, regexp_replace({BODY}, '\\n{{2,}}', chr(10), 'g') as content, n_chars as "view", n_chars % 100 as "like", null::bigint as dislike,
      len(lines)::bigint as comment_count, time as created_at""",
    f"null, case when pos % 6 <> 5 then trim(line, {WS}) end, null, case when pos % 6 <> 5 then pos end, case when pos % 6 <> 5 then 1 end, null, case when pos % 6 <> 5 then time end",
)

# Old entity names count without their semicolon too, as where a title was cut off.
UNESCAPE = "regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '&middot;?', '·', 'g'), '&copy;?', '©', 'g'), '&quot;?', '\"', 'g'), '&amp;?', '&', 'g')"


@query("parse_generic", f"""select page_id, url, trim({UNESCAPE.format("regexp_extract(html, '<title>([^<]*)</title>', 1)")}, {WS}) as title,
  array_to_string(list_filter(list_transform(string_split_regex(regexp_extract(html, '<article>([\\s\\S]*)</article>', 1), '<[^>]*>'),
    lambda p: trim({UNESCAPE.format('p')}, {WS})), lambda p: p <> ''), chr(10)) as content,
  array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), ' ') as links from pages""")
def parse_generic(spark, sf):
    return G.parse_generic(A.table(spark, sf, "pages")).withColumn("links", F.array_join("links", " "))
