"""The given tables seen as the domain's tables.

Each view is a projection of one given table, or a join of two on a unique key, so
it scales with that table and groups nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import POSTS_SCHEMA

BATCH = "2025-02-24 13:45:03"
NOW = "2025-02-24 13:45:03"
SITES = ("bobaedream", "clien", "dcinside")

# Terms that do occur in the given texts, which have no Korean.
LATIN_LEXICON = [
    ("accident", "tion", "tion"), ("accident", "ing", "ing"),
    ("brand", "sch", "sch"), ("brand", "eaux", "eaux"),
    ("model", "the ", "the_lower"), ("model", "The", "the_upper"),
    ("ev_issue", "qqzz", "qqzz"), ("ev_issue", "est", "est"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def minutes(c: Column) -> Column:
    """An interval of that many minutes, safe beyond the 32-bit range of minutes."""
    days = F.floor(c / 1440).cast("int")
    return F.make_dt_interval(days=days, mins=(c % 1440).cast("int"))


def checked_at(key: Column, many: bool) -> Column:
    """One batch time for all rows, or 288 five-minute batches of a day."""
    if not many:
        return F.lit(BATCH).cast("timestamp_ntz")
    return F.lit("2025-02-24 00:00:03").cast("timestamp_ntz") + minutes(key % 288 * 5)


def site(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in SITES]), (key % 3 + 1).cast("int"))


def posts(spark: SparkSession, sf_dir: str, many: bool = False, prepare: Callable[[DataFrame], DataFrame] | None = None, labelled: bool = True) -> DataFrame:
    """Documents with their labels. ``prepare`` is applied before the labels are joined,
    for work that can shrink the rows the join may have to shuffle. Without ``labelled``
    nothing is joined and the columns that come from labels are absent."""
    key = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(
        key,
        F.col("source").alias("platform"),
        F.substring_index("text", "\n", 1).alias("title"),
        key.cast("string").alias("post_id"),
        F.concat(F.lit("https://example.invalid/"), "source", F.lit("/"), key.cast("string")).alias("url"),
        F.col("text").alias("content"),
        F.col("n_chars").alias("view"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + minutes(key)).alias("created_at"),
        F.lit(0).cast("bigint").alias("comment_count"),
        F.col("lang").alias("keywords"),
        checked_at(key, many).alias("checked_at"),
    )
    rows = prepare(rows) if prepare else rows
    if not labelled:
        return rows.drop("doc_id")
    joined = rows.join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumns({
        "like": F.col("quality").cast("bigint"),
        "dislike": F.col("toxic").cast("bigint"),
        "sentiment": F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .when(F.col("quality") == 0, "neutral"),
    })
    contract = [name for name in POSTS_SCHEMA.names if name in joined.columns]
    added = [name for name in rows.columns if name not in contract and name != "doc_id"]
    return joined.select(*contract, *added)


def comments(spark: SparkSession, sf_dir: str, many: bool = False) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + minutes(F.col("turn"))).alias("created_at"),
        F.col("text").alias("content"),
        F.lit(None).cast("bigint").alias("like"),
        F.lit(None).cast("bigint").alias("dislike"),
        F.col("conv_id").cast("string").alias("post_id"),
        F.when(F.col("role") == "assistant", "positive")
        .when(F.col("role") == "user", "negative")
        .otherwise("neutral")
        .alias("sentiment"),
        checked_at(F.col("conv_id"), many).alias("checked_at"),
    )


def nested_posts(spark: SparkSession, sf_dir: str, edges: bool = False) -> DataFrame:
    """Posts before landing: a document, with its lines as comments.

    Counts and reactions are text, some of it not numeric. ``edges``, for operators that
    are about them: some posts failed, some have no content or no comment list.
    """
    absent = lambda n: (key % n == 0) if edges else F.lit(False)
    key = F.col("doc_id")
    comment = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.lit(None).cast("timestamp_ntz").alias("created_at"),
            line.alias("content"),
            F.when(i % 3 == 0, F.lit("1,000")).otherwise(i.cast("string")).alias("like"),
            F.lit(None).cast("string").alias("dislike"),
            F.lit(None).cast("string").alias("sentiment"),
        ),
    )
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("platform"),
        F.when(key % 4 != 0, F.substring_index("text", "\n", 1)).alias("title"),
        key.cast("string").alias("post_id"),
        F.concat(F.lit("/d/"), key.cast("string")).alias("url"),
        F.when(~absent(6), F.col("text")).alias("content"),
        F.col("n_chars").cast("string").alias("view"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + minutes(key)).alias("created_at"),
        F.when(key % 2 == 0, F.col("lang")).otherwise((key % 100).cast("string")).alias("like"),
        F.lit(None).cast("string").alias("dislike"),
        F.lit("0").alias("comment_count"),
        F.when(key % 8 != 0, F.array(F.concat(F.lit(" "), "lang"), F.concat("source", F.lit("\n")))).alias("keywords"),
        F.lit(None).cast("string").alias("sentiment"),
        F.when(absent(7), "FAILED").otherwise("UNCHANGED").alias("status"),
        F.when(~absent(5), comment).alias("comment"),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One labelling reply per document: fenced, plain, empty, broken or incomplete."""
    key = F.col("doc_id")
    label = lambda n: F.element_at(F.array(F.lit("positive"), F.lit("neutral"), F.lit("negative")), (n % 3 + 1).cast("int"))
    lines = F.split("text", "\n")
    labelled = F.transform(lines, lambda line: F.struct(F.lit("-").alias("내용"), label(F.length(line)).alias("감정")))
    # Some replies label fewer comments than the post has, some more.
    items = F.when(key % 9 == 4, F.slice(labelled, 1, 1)).when(key % 9 == 5, F.concat(labelled, labelled)).otherwise(labelled)
    full = F.to_json(F.struct(label(key).alias("게시글_감정"), items.alias("댓글_분석")))
    no_label = F.to_json(F.struct(items.alias("댓글_분석")))
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("platform"),
        key.cast("string").alias("post_id"),
        F.when(key % 11 == 0, "sorry, no answer")
        .when(key % 13 == 0, "{}")
        .when(key % 10 == 3, no_label)
        .when(key % 2 == 0, F.concat(F.lit("```json\n"), full, F.lit("\n```")))
        .otherwise(full)
        .alias("reply"),
    )


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing hits from the event log, arrival order = event_id."""
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "signup", "BANNED").otherwise("CHANGED")
    return table(spark, sf_dir, "events").select(
        site(F.col("user_id")).alias("platform"),
        F.concat(F.lit("/u/"), F.col("user_id").cast("string")).alias("url"),
        F.col("user_id").cast("string").alias("post_id"),
        status.alias("status"),
        (F.floor("value").cast("int") % 50).alias("comment_count"),
        F.floor(F.col("value") * 10).cast("int").alias("view"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("checked_at"),
        F.col("event_type").alias("keyword"),
        F.col("event_id").alias("seq"),
    )


def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl state from the orders, one row per order."""
    key = F.col("o_orderkey")
    status = F.element_at(F.array(*[F.lit(s) for s in ("CHANGED", "UNCHANGED", "FAILED", "BANNED")]), (key % 4 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        site(key).alias("platform"),
        F.concat(F.lit("/o/"), key.cast("string")).alias("url"),
        F.array("o_orderpriority").alias("keywords"),
        key.cast("string").alias("post_id"),
        status.alias("status"),
        (key % 50).cast("int").alias("comment_count"),
        F.col("o_orderdate").alias("created_at"),
        (F.lit("2025-02-24 12:00:00").cast("timestamp_ntz") + minutes(key % 90)).alias("checked_at"),
        F.floor("o_totalprice").cast("int").alias("view"),
    )


def order_key(event: str = "event_id", user: str = "user_id") -> Column:
    """The order an event is about."""
    return F.col(user) * 10 + F.col(event) % 10


def status_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status reports about tracked URLs; clicks and views come without a time."""
    key, kind = order_key(), F.col("event_type")
    status = F.when(kind == "error", "FAILED").when(kind == "signup", "BANNED").when(kind == "view", "UNCHANGED")
    return table(spark, sf_dir, "events").select(
        site(key).alias("platform"),
        F.concat(F.lit("/o/"), key.cast("string")).alias("url"),
        status.otherwise("CHANGED").alias("status"),
        F.when(~kind.isin("click", "view"), F.col("ts")).alias("checked_at"),
        F.col("event_id").alias("seq"),
    )


def detail_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures read from detail pages of tracked URLs; a signup has no views."""
    key = order_key()
    return table(spark, sf_dir, "events").select(
        site(key).alias("platform"),
        F.concat(F.lit("/o/"), key.cast("string")).alias("url"),
        (F.floor("value").cast("int") % 50).alias("comment_count"),
        F.when(F.col("event_type") != "signup", F.floor(F.col("value") * 10).cast("int")).alias("view"),
        F.col("ts").alias("created_at"),
        F.col("event_id").alias("seq"),
    )


def sparse_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail page per line item of a tracked order, many fields missing."""
    key, part = F.col("l_orderkey"), F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        site(key).alias("platform"),
        F.concat(F.lit("/o/"), key.cast("string")).alias("url"),
        F.when(part % 2 == 0, F.col("l_returnflag")).alias("title"),
        F.when(part % 3 == 0, F.col("l_linestatus")).alias("content"),
        F.when(part % 5 == 0, part.cast("int")).alias("view"),
        F.when(part % 7 == 0, F.col("l_linenumber")).alias("comment_count"),
        F.when(part % 2 == 1, F.col("l_shipdate")).alias("created_at"),
        F.when(part % 4 == 0, F.col("l_suppkey")).alias("like"),
    )


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search results, newest first: the event log read backwards, with late old rows."""
    key = F.col("event_id")
    late = F.when(key % 997 == 0, F.make_dt_interval(days=F.lit(20))).otherwise(F.make_dt_interval())
    return table(spark, sf_dir, "events").select(
        site(F.col("user_id")).alias("source"),
        F.col("event_type").alias("keyword"),
        (-key).alias("pos"),
        F.col("user_id").alias("post_id"),
        (F.col("ts") - late).alias("created_at"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paged search results; from some page on a listing shows the same posts again."""
    key = F.col("event_id")
    slot = key % 5
    page = F.floor(key / 600)
    repeats = F.when(page % (slot + 3) == slot + 2, 600).otherwise(0)
    return table(spark, sf_dir, "events").select(
        site(key).alias("source"),
        F.concat(F.lit("k"), slot.cast("string")).alias("keyword"),
        page.alias("page"),
        key.alias("pos"),
        (key - repeats).alias("post_id"),
    )


def escaped(c: Column) -> Column:
    """Text as it stands in markup."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def stamp(c: Column, style: str) -> Column:
    return F.date_format(c, style)


def page_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the site pages below are written from: a document, its lines and its time."""
    key = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        key.alias("page_id"),
        key,
        "text",
        "n_chars",
        "lang",
        "source",
        F.split("text", "\n").alias("lines"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + minutes(key)).alias("time"),
    )


def joined(lines: Column, one) -> Column:
    return F.array_join(F.transform(lines, one), "")


def listing_html(spark: SparkSession, sf_dir: str, site_name: str, *about: str) -> DataFrame:
    """Listing pages in a site's markup: one page per document, one row per line.

    ``about`` names columns of the documents that stay beside their pages.
    """
    parts = page_parts(spark, sf_dir)
    number = lambda i: (F.col("doc_id") * 100000 + i).cast("string")
    boards = F.array(F.lit("자유게시판"), F.lit("내차사진"), F.lit("news"), F.lit("국산차게시판"))

    def dcinside(line: Column, i: Column) -> Column:
        return F.concat(
            F.lit('<tr class="ub-content us-post" data-no="'), number(i),
            F.lit('"><td class="gall_tit ub-word"><a href="/board/view/?no='), number(i), F.lit('"><em></em>'), escaped(line),
            F.lit("</a>"),
            F.when(i % 2 == 0, F.concat(F.lit('<a class="reply_numbox"><span class="reply_num">['), i.cast("string"), F.lit("]</span></a>"))).otherwise(""),
            F.lit('</td><td class="gall_date" title="'), stamp(F.col("time"), "yyyy-MM-dd HH:mm:ss"),
            F.lit('">x</td><td class="gall_count">'), F.format_number("n_chars", 0), F.lit("</td></tr>"),
        )

    def clien(line: Column, i: Column) -> Column:
        tenths = (F.col("n_chars") % 10).cast("string")
        return F.concat(
            F.lit('<div class="list_item symph_row jirum" data-board-sn="'), number(i),
            F.lit('"><a class="subject_fixed" href="/service/'), number(i), F.lit('">'), escaped(line), F.lit("</a>"),
            F.when(i % 2 == 0, F.concat(F.lit('<span class="rSymph05">'), i.cast("string"), F.lit("</span>"))).otherwise(""),
            F.lit('<span class="hit">'), F.col("n_chars").cast("string"), F.lit("."), tenths, F.lit(" k</span>"),
            F.lit('<span class="timestamp">'), stamp(F.col("time"), "yyyy-MM-dd HH:mm:ss"), F.lit("</span></div>"),
        )

    def bobaedream(line: Column, i: Column) -> Column:
        return F.concat(
            F.lit('<li><dl><dt><a href="/view?code=x&amp;No='), number(i), F.lit('">'), escaped(line),
            F.lit('</a></dt><dd class="path"><span>'), F.element_at(boards, i % 4 + 1),
            F.lit("</span><span>w</span><span>"), stamp(F.col("time"), "yy. MM. dd"), F.lit("</span></dd></dl></li>"),
        )

    rows = {"dcinside": dcinside, "clien": clien, "bobaedream": bobaedream}[site_name]
    opening, closing = {
        "dcinside": ("<table><tbody>", "</tbody></table>"),
        "clien": ('<a class="board-nav-page active">1</a>', ""),
        "bobaedream": ('<div class="search_Community"><ul>', "</ul></div>"),
    }[site_name]
    return parts.select("page_id", *about, F.concat(F.lit(opening), joined(F.col("lines"), rows), F.lit(closing)).alias("html"))


def detail_html(spark: SparkSession, sf_dir: str, site_name: str) -> DataFrame:
    """Detail pages in a site's markup: a document as the post, its lines as comments.

    Some pages lack views; some comments are blocked or deleted, by position.
    """
    return page_parts(spark, sf_dir).select("page_id", detail_markup(site_name).alias("html"))


def every_detail_html(spark: SparkSession, sf_dir: str, of: Column) -> DataFrame:
    """Detail pages of all sites, each in the markup of the site ``of`` names, in one scan."""
    html = reduce(lambda pages, name: pages.when(of == name, detail_markup(name)), SITES[1:], F.when(of == SITES[0], detail_markup(SITES[0])))
    return page_parts(spark, sf_dir).select("page_id", of.alias("platform"), html.alias("html"))


def detail_markup(site_name: str) -> Column:
    """A site's detail page of a row of :func:`page_parts`."""
    key, views = F.col("doc_id"), F.col("n_chars")
    body, title = escaped(F.col("text")), F.concat(F.lit("t"), F.col("doc_id").cast("string"))
    count = F.size("lines").cast("string")

    def when_known(*pieces: Column) -> Column:
        return F.when(key % 3 != 0, F.concat(*pieces)).otherwise("")

    if site_name == "dcinside":
        comment = lambda line, i: F.concat(
            F.lit('<li class="ub-content"><div class="clear cmt_txtbox"><p class="usertxt ub-word">'), escaped(line), F.lit("</p></div></li>"))
        return F.concat(
            F.lit("<html><head><title> "), title, F.lit(' </title></head><div class="write_div">'), body, F.lit("</div>"),
            when_known(F.lit('<span class="gall_count">조회 '), F.format_number(views, 0), F.lit("</span>")),
            F.lit('<div class="up_num_box"><p class="up_num">'), (views % 100).cast("string"), F.lit("</p></div>"),
            F.lit('<span class="gall_comment">댓글 '), count, F.lit("</span><ul>"), joined(F.col("lines"), comment), F.lit("</ul>"),
        )
    elif site_name == "clien":
        comment = lambda line, i: F.concat(
            F.lit('<div class="comment_row'), F.when(i % 5 == 4, " blocked").otherwise(""), F.lit('"><div class="comment_view">'), escaped(line),
            F.lit('</div><span class="timestamp">'), stamp(F.col("time"), "yyyy-MM-dd HH:mm:ss"), F.lit(" / 수정</span>"),
            F.when(i % 2 == 0, F.concat(F.lit('<div class="comment_content_symph"><strong>'), i.cast("string"), F.lit("</strong></div>"))).otherwise(""),
            F.lit("</div>"))
        return F.concat(
            F.lit('<h3 class="post_subject"><span>'), title, F.lit('</span><span>x</span></h3><div class="post_article"><p>'), body, F.lit("</p></div>"),
            when_known(F.lit('<div class="post_author"><span class="view_count">v <strong>'), F.format_number(views, 0), F.lit("</strong></span></div>")),
            F.lit('<a class="symph_count"><strong>'), (views % 100).cast("string"), F.lit('</strong></a><a class="post_reply"><span>'), count,
            F.lit("</span></a>"), joined(F.col("lines"), comment),
        )
    else:
        comment = lambda line, i: F.concat(
            F.lit("<li><dl><dt><span>a</span><span>b</span><span>c</span><span>"), stamp(F.col("time"), "yy.MM.dd HH:mm"),
            F.lit("</span></dt><dd>"), F.when(i % 6 == 5, F.lit("삭제된 댓글입니다")).otherwise(escaped(line)),
            F.lit('</dd></dl><div class="updownbox"><dl><dd>추천 '), i.cast("string"), F.lit("</dd><dd>반대 1</dd></dl></div></li>"))
        return F.concat(
            F.lit('<div class="writerProfile"><dl><dt title="'), title, F.lit('">x</dt><span class="countGroup">조회 <em>'), F.format_number(views, 0),
            F.lit("</em> | <em>x</em> 추천 <em>"), (views % 100).cast("string"), F.lit("</em> | "), stamp(F.col("time"), "yyyy.MM.dd"),
            F.lit("&amp;nbsp;(월) "), stamp(F.col("time"), "HH:mm"), F.lit('</span></dl></div><div class="bodyCont">\n'), body,
            F.lit('\n\n\n</div><div id="cmt_list"><ul class="basiclist">'), joined(F.col("lines"), comment), F.lit("</ul></div>"),
        )


def keyword_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One named set per language: the sources that publish in it."""
    pairs = table(spark, sf_dir, "documents").select(F.col("lang").alias("name"), "source").distinct()
    return pairs.groupBy("name").agg(F.sort_array(F.collect_list("source")).alias("keywords"))
