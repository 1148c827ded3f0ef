"""SQL twins of the adapter views, and helpers to write SQL twins of queries."""

from __future__ import annotations

from ..lexicon import Lexicon
from ..sources.adapters import BATCH, SITES

START = "timestamp '2024-01-01 00:00:00'"


def site(key: str) -> str:
    names = ", ".join(f"'{name}'" for name in SITES)
    return f"[{names}][{key} % 3 + 1]"


def checked_at(key: str, many: bool) -> str:
    if many:
        return f"timestamp '2025-02-24 00:00:03' + ({key} % 288 * 5) * interval 1 minute"
    return f"timestamp '{BATCH}'"


def posts(many: bool = False) -> str:
    return f"""posts as (
  select source as platform, split_part(text, chr(10), 1) as title, cast(doc_id as varchar) as post_id,
         'https://example.invalid/' || source || '/' || doc_id as url, text as content, n_chars as "view",
         {START} + doc_id * interval 1 minute as created_at, cast(quality as bigint) as "like",
         cast(toxic as bigint) as dislike, cast(0 as bigint) as comment_count, lang as keywords,
         case when toxic = 1 then 'negative' when quality = 1 then 'positive' when quality = 0 then 'neutral' end as sentiment,
         {checked_at('doc_id', many)} as checked_at
  from documents left join labels using (doc_id))"""


def comments(many: bool = False) -> str:
    return f"""comments as (
  select {START} + turn * interval 1 minute as created_at, text as content, cast(null as bigint) as "like",
         cast(null as bigint) as dislike, cast(conv_id as varchar) as post_id,
         case role when 'assistant' then 'positive' when 'user' then 'negative' else 'neutral' end as sentiment,
         {checked_at('conv_id', many)} as checked_at
  from conversations)"""


MERGED = """merged as (
  select platform, title, post_id, url, content, "view", created_at, "like", dislike, comment_count, keywords, sentiment, checked_at from posts
  union all
  select null, null, post_id, null, content, null, created_at, "like", dislike, null, null, sentiment, checked_at from comments)"""

NESTED = f"""nested as (
  select doc_id, source as platform, case when doc_id % 4 <> 0 then split_part(text, chr(10), 1) end as title,
         cast(doc_id as varchar) as post_id, '/d/' || doc_id as url, text as content,
         n_chars as "view", {START} + doc_id * interval 1 minute as created_at,
         case when doc_id % 2 <> 0 then doc_id % 100 end as "like",
         case when doc_id % 8 <> 0 then lang || '-' || source else 'no_keyword' end as keywords,
         'UNCHANGED' as status,
         string_split(text, chr(10)) as lines
  from documents),
lines as (
  select doc_id, platform, post_id, created_at, status, unnest(lines) as line, generate_subscripts(lines, 1) - 1 as pos
  from nested)"""

NESTED_EDGES = f"""nested as (
  select doc_id, source as platform, case when doc_id % 4 <> 0 then split_part(text, chr(10), 1) end as title,
         cast(doc_id as varchar) as post_id, '/d/' || doc_id as url, case when doc_id % 6 <> 0 then text end as content,
         n_chars as "view", {START} + doc_id * interval 1 minute as created_at,
         case when doc_id % 2 <> 0 then doc_id % 100 end as "like",
         case when doc_id % 8 <> 0 then lang || '-' || source else 'no_keyword' end as keywords,
         case when doc_id % 7 = 0 then 'FAILED' else 'UNCHANGED' end as status,
         case when doc_id % 5 <> 0 then string_split(text, chr(10)) end as lines
  from documents),
lines as (
  select doc_id, platform, post_id, created_at, status, unnest(lines) as line, generate_subscripts(lines, 1) - 1 as pos
  from nested)"""

HITS = f"""hits as (
  select {site('user_id')} as platform, '/u/' || user_id as url, cast(user_id as varchar) as post_id,
         case event_type when 'error' then 'FAILED' when 'signup' then 'BANNED' else 'CHANGED' end as status,
         cast(floor(value) as int) % 50 as comment_count, cast(floor(value * 10) as int) as "view",
         ts as created_at, ts as checked_at, event_type as keyword, event_id as seq
  from events)"""

TRACKING = f"""tracking as (
  select {site('o_orderkey')} as platform, '/o/' || o_orderkey as url, o_orderpriority as keywords,
         cast(o_orderkey as varchar) as post_id,
         ['CHANGED', 'UNCHANGED', 'FAILED', 'BANNED'][o_orderkey % 4 + 1] as status,
         cast(o_orderkey % 50 as int) as comment_count, o_orderdate as created_at,
         timestamp '2025-02-24 12:00:00' + (o_orderkey % 90) * interval 1 minute as checked_at,
         cast(floor(o_totalprice) as int) as "view"
  from orders)"""

CHANGES = f"""changes as (
  select {site('k')} as platform, '/o/' || k as url, event_id as seq,
         case event_type when 'error' then 'FAILED' when 'signup' then 'BANNED' when 'view' then 'UNCHANGED' else 'CHANGED' end as status,
         case when event_type not in ('click', 'view') then ts end as checked_at
  from (select *, user_id * 10 + event_id % 10 as k from events))"""


def merged(many: bool = False) -> str:
    return ",\n".join([posts(many), comments(many), MERGED])


def with_views(views: str, body: str) -> str:
    return f"with {views}\n{body}"


BASE_METRICS = """cast(sum("view") as bigint) as total_views, count(*) as total_posts_comments,
  cast(sum(case when sentiment = 'positive' then 1 when sentiment is not null then 0 end) as bigint) as positive,
  cast(sum(case when sentiment = 'neutral' then 1 when sentiment is not null then 0 end) as bigint) as neutral,
  cast(sum(case when sentiment = 'negative' then 1 when sentiment is not null then 0 end) as bigint) as negative"""


def flag(term: str) -> str:
    return f"case when contains(content, '{term}') then 1 else 0 end"


def totals(lexicon: Lexicon) -> str:
    return ",\n  ".join(f"cast(sum({flag(term)}) as bigint) as {name}_total_count" for _, term, name in lexicon)
