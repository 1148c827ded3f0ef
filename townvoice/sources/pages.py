"""Listing and detail pages to tables.

Tasks only pick raw strings out of the markup, one page at a time; cleaning and typing
are column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, StringType, StructField, StructType

from ..functions.text import (
    absolute_url,
    clean_content,
    lenient_int,
    parse_count,
    parse_si_count,
    post_id_from_url,
    strip,
)
from ..functions.times import parse_community_ts
from ..operators.listing import force_refresh_sentinel
from ..operators.normalize import COMMENT_FIELDS, DELETED_COMMENT, salt_post_id
from ..schemas import NOT_KNOWN
from .markup import Element, attr_of, parse, text_of

# Where the sites live; their pages link by path.
HOSTS = {
    "bobaedream": "https://www.bobaedream.co.kr",
    "clien": "https://www.clien.net",
    "dcinside": "https://gall.dcinside.com",
}

TEXT = StringType()
LISTING_FIELDS = ("title", "path", "post_id", "category", "writer", "comment_count", "view", "created_at")
LISTING_ROWS = ArrayType(StructType([StructField(name, TEXT) for name in LISTING_FIELDS]))
RAW_COMMENT = StructType([*[StructField(name, TEXT) for name in COMMENT_FIELDS], StructField("blocked", BooleanType())])
DETAIL_FIELDS = ("title", "content", "view", "like", "dislike", "comment_count", "created_at")
DETAIL = StructType([*[StructField(name, TEXT) for name in DETAIL_FIELDS], StructField("comment", ArrayType(RAW_COMMENT))])
GENERIC = StructType([StructField("title", TEXT), StructField("content", TEXT), StructField("links", ArrayType(TEXT))])


# Element paths of the three sites. They describe the sites' markup.

def dcinside_listing(page: Element) -> Iterator[dict]:
    for row in page.find("tr.ub-content.us-post"):
        link = next((a for a in row.find("td.gall_tit.ub-word", "a") if a.first_child()), None)
        if link is not None:
            yield {
                "title": link.text(),
                "path": attr_of(link, "href"),
                "post_id": attr_of(row, "data-no"),
                "comment_count": text_of(row.first("td.gall_tit.ub-word", "a.reply_numbox", "span.reply_num")),
                "view": text_of(row.first("td.gall_count")),
                "created_at": attr_of(row.first("td.gall_date"), "title"),
            }


def clien_listing(page: Element) -> Iterator[dict]:
    if page.first("a.board-nav-page.active") is None:  # beyond the last page
        return
    for row in page.find("div.list_item.symph_row.jirum"):
        link = row.first("a.subject_fixed")
        yield {
            "title": text_of(link),
            "path": attr_of(link, "href"),
            "post_id": attr_of(row, "data-board-sn"),
            "comment_count": text_of(row.first("span.rSymph05")),
            "view": text_of(row.first("span.hit")),
            "created_at": text_of(row.first("span.timestamp")),
        }


def bobaedream_listing(page: Element) -> Iterator[dict]:
    for row in page.find("div.search_Community", "li"):
        link = row.first("dt", "a")
        about = [span.text() for span in row.find("dd.path", "span")]
        if link is not None and len(about) > 2:
            category, writer, created_at = about[:3]
            yield {
                "title": link.text(), "path": attr_of(link, "href"),
                "category": category, "writer": writer, "created_at": created_at,
            }


def dcinside_detail(page: Element) -> dict:
    return {
        "title": text_of(page.first("title")),
        "content": text_of(page.first("div.write_div")),
        "view": text_of(page.first("span.gall_count")),
        "like": text_of(page.first("div.up_num_box", "p.up_num")),
        "dislike": text_of(page.first("div.down_num_box", "p.down_num")),
        "comment_count": text_of(page.first("span.gall_comment")),
        "comment": [
            {"content": text.text()}
            for text in page.find("li.ub-content", "div.clear.cmt_txtbox", "p.usertxt.ub-word")
        ],
    }


def clien_detail(page: Element) -> dict:
    return {
        "title": text_of(page.first("h3.post_subject", "span")),
        "content": text_of(page.first("div.post_article"), "\n"),
        "view": text_of(page.first("div.post_author", "span.view_count", "strong")),
        "like": text_of(page.first("a.symph_count", "strong")),
        "comment_count": text_of(page.first("a.post_reply", "span")),
        "comment": [
            {
                "content": text_of(row.first("div.comment_view"), "\n"),
                "created_at": text_of(row.first("span.timestamp")),
                "like": text_of(row.first("div.comment_content_symph", "strong")) or "0",
                "blocked": "blocked" in row.classes,
            }
            for row in page.find("div.comment_row")
        ],
    }


def bobaedream_detail(page: Element) -> dict:
    rows = list(page.find("div#cmt_list", "ul.basiclist", "li"))
    comments = []
    for row in rows:
        about = list(row.find("dl", "dt", "span"))
        votes = list(row.find("div.updownbox", "dd"))
        body = row.first("dd")
        if DELETED_COMMENT in row.text():
            comments.append({"content": DELETED_COMMENT})
        elif len(about) > 3 and len(votes) > 1 and body is not None:
            comments.append({
                "content": body.text(), "created_at": about[3].text(),
                "like": votes[0].text(), "dislike": votes[1].text(),
            })
    heading = page.first("div.writerProfile", "dl")
    counts = heading.first("span.countGroup") if heading else None
    numbers = list(counts.find("em")) if counts else []
    return {
        "title": attr_of(heading.first("dt"), "title") if heading else None,
        "content": text_of(page.first("div.bodyCont")),
        "view": numbers[0].text() if numbers else None,
        "like": numbers[2].text() if len(numbers) > 2 else None,
        "comment_count": str(len(rows)),
        "created_at": counts.text().split("|")[-1] if counts else None,
        "comment": comments,
    }


def generic(page: Element) -> dict:
    article = page.first("article")
    return {
        "title": text_of(page.first("title")),
        "content": text_of(article, "\n"),
        "links": [attr_of(a, "href") for a in page.find("a") if "href" in a.attrs],
    }


LISTINGS = {"dcinside": dcinside_listing, "clien": clien_listing, "bobaedream": bobaedream_listing}
DETAILS = {"dcinside": dcinside_detail, "clien": clien_detail, "bobaedream": bobaedream_detail}


NEEDED = ["url", "post_id", "comment_count", "view", "created_at"]


PIECE = 1 << 21  # characters of pages whose results are kept at once
PIECE_ROWS = 1000


def arrow_type(kind: DataType) -> pa.DataType:
    if isinstance(kind, ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, StructType):
        return pa.struct([(field.name, arrow_type(field.dataType)) for field in kind.fields])
    return pa.bool_() if isinstance(kind, BooleanType) else pa.string()


def column_of(values: list, kind: pa.DataType) -> pa.Array:
    """Python values as an Arrow array, lists and dicts field by field, which is faster than row by row."""
    if pa.types.is_list(kind):
        starts, items = [], []
        for value in values:
            starts.append(None if value is None else len(items))
            items.extend(value or ())
        return pa.ListArray.from_arrays(pa.array([*starts, len(items)], pa.int32()), column_of(items, kind.value_type), type=kind)
    if pa.types.is_struct(kind):
        return pa.StructArray.from_arrays([column_of([value.get(field.name) for value in values], field.type) for field in kind], fields=list(kind))
    return pa.array(values, kind)


def picked(pages: Iterator[pa.Array], pick: Callable[[Element], object], kind: pa.DataType) -> Iterator[pa.Array]:
    """What ``pick`` finds on each page, handed on in pieces: a task holds one page's tree
    and the results of about :data:`PIECE` characters, however many pages a batch has."""
    many = pa.types.is_list(kind)
    for batch in pages:
        out, size = [], 0
        for cell in batch:
            html = cell.as_py()
            found = None if html is None else pick(parse(html))
            out.append(list(found or ()) if many else found or {})
            size += len(html or "")
            if size >= PIECE or len(out) >= PIECE_ROWS:
                yield column_of(out, kind)
                out, size = [], 0
        if out:
            yield column_of(out, kind)


def extract(html: Column, pick: Callable[[Element], object], kind: DataType) -> Column:
    """Apply ``pick`` to every page; absent fields are NULL."""
    arrow = arrow_type(kind)

    @F.arrow_udf(kind)
    def run(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return picked(pages, pick, arrow)

    # pages are costly: a filter on what was found must not bring the function in a second time
    return run.asNondeterministic()(html)


def page_keys(pages: DataFrame) -> list[str]:
    return [name for name in pages.columns if name != "html"]


def parse_listing(pages: DataFrame, site: str) -> DataFrame:
    """Result rows of listing pages: the page's columns, ``pos`` on the page, typed fields.

    Rows whose counts or time cannot be read, or are beyond the contract's integers, are
    in :func:`rejected_listing`; posts of unknown boards are no results.
    """
    return listing_rows(pages, site).dropna(subset=NEEDED)


def rejected_listing(pages: DataFrame, site: str) -> DataFrame:
    """The rows that :func:`parse_listing` cannot use; what could not be read is NULL."""
    rows = listing_rows(pages, site)
    return rows.filter(" or ".join(f"{name} is null" for name in NEEDED))


def listing_rows(pages: DataFrame, site: str) -> DataFrame:
    keys = [name if name != "url" else "page_url" for name in page_keys(pages)]
    pages = pages.withColumnRenamed("url", "page_url")
    rows = pages.select(*keys, extract(F.col("html"), LISTINGS[site], LISTING_ROWS).alias("_rows"))
    # The outer form: the plain one would check the array first, parsing each page twice.
    found = rows.select(*keys, F.posexplode_outer("_rows").alias("pos", "_row")).filter(F.col("pos").isNotNull())
    raw = found.select(*keys, "pos", "_row.*")
    typed = raw.withColumns({"title": strip(F.col("title")), "url": absolute_url(HOSTS[site], F.col("path"))})
    if site == "bobaedream":
        typed = typed.withColumns({
            "post_id": post_id_from_url(F.col("path")),
            "created_at": parse_community_ts(F.col("created_at"), "date"),
        }).filter(F.col("post_id").isNotNull())
        typed = force_refresh_sentinel(salt_post_id(typed))
    else:
        views = parse_count(F.col("view")) if site == "dcinside" else parse_si_count(F.col("view"))
        typed = typed.withColumns({
            "comment_count": parse_count(F.col("comment_count")).try_cast("int"),
            "view": views.try_cast("int"),
            "created_at": parse_community_ts(F.col("created_at"), "seconds"),
            "status": F.lit("CHANGED"),
        })
    return typed.select(
        *keys, "pos", "title", "url", "post_id", "category", "writer", "comment_count", "view", "created_at", "status"
    )


def typed_comments(site: str) -> Column:
    def one(c: Column) -> Column:
        deleted = F.coalesce(F.contains(c["content"], F.lit(DELETED_COMMENT)), F.lit(False)) if site == "bobaedream" else F.lit(False)
        layout = {"bobaedream": "minutes", "clien": "seconds", "dcinside": "seconds"}[site]
        values = {
            "created_at": parse_community_ts(c["created_at"], layout),
            "content": strip(c["content"]),
            "like": vote(c["like"]),
            "dislike": vote(c["dislike"]),
        }
        fields = [F.when(~deleted, value).alias(name) for name, value in values.items()]
        return F.struct(*fields, F.lit(None).cast("string").alias("sentiment"))

    def vote(c: Column) -> Column:
        return F.when(c.isNotNull(), parse_count(c))

    shown = F.filter(F.col("comment"), lambda c: ~F.coalesce(c["blocked"], F.lit(False)))
    return F.transform(shown, one)


# What a detail page must show: the crawlers of these sites skip pages without heading or body.
NEEDED_DETAIL = {"bobaedream": ("title", "content"), "clien": ("title", "content"), "dcinside": ()}


def parse_detail(pages: DataFrame, site: str) -> DataFrame:
    """Posts of detail pages: the page's columns, typed fields and the comment list.

    Fields a page lacks are NULL, on one site views and likes that it does not show the
    not-known mark; :func:`~townvoice.operators.normalize.default_missing` fills NULLs from the
    crawl state. Blocked comments are removed, on one site deleted ones are blanked. Pages
    without heading or body, and missing ones, are in :func:`rejected_detail`.
    """
    return detail_rows(pages, site).filter("_readable").drop("_readable")


def rejected_detail(pages: DataFrame, site: str) -> DataFrame:
    """The pages that :func:`parse_detail` cannot use, with what could be read."""
    return detail_rows(pages, site).filter("not _readable").drop("_readable")


def detail_rows(pages: DataFrame, site: str) -> DataFrame:
    keys = page_keys(pages)
    raw = pages.select(*keys, extract(F.col("html"), DETAILS[site], DETAIL).alias("_page"))
    readable = F.col("comment").isNotNull()
    for name in NEEDED_DETAIL[site]:
        readable = readable & F.col(name).isNotNull()
    shown = lambda name, value: F.when(F.col(name).isNotNull(), value)
    view, like = parse_count(F.col("view")), parse_count(F.col("like"))
    if site == "bobaedream":
        view = F.coalesce(shown("view", view), F.lit(NOT_KNOWN).cast("bigint"))
        like = shown("like", lenient_int(F.col("like"))).when(F.col("like").isNull(), NOT_KNOWN)
    return raw.select(*keys, "_page.*").withColumn("_readable", readable).withColumns({
        "title": strip(F.col("title")),
        "content": clean_content(F.col("content")) if site == "bobaedream" else strip(F.col("content")),
        "view": view if site == "bobaedream" else shown("view", view),
        "like": like,
        "dislike": parse_count(F.col("dislike")) if site == "dcinside" else F.lit(None).cast("bigint"),
        "comment_count": parse_count(F.col("comment_count")) if site != "dcinside"
        else shown("comment_count", parse_count(F.col("comment_count"))),
        "created_at": parse_community_ts(F.col("created_at"), "weekday"),
        "comment": typed_comments(site),
    })


def parse_generic(pages: DataFrame) -> DataFrame:
    """Title, article text and link targets of any page."""
    keys = page_keys(pages)
    raw = pages.select(*keys, extract(F.col("html"), generic, GENERIC).alias("_page"))
    return raw.select(*keys, strip(F.col("_page.title")).alias("title"), "_page.content", "_page.links")
