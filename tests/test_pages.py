"""Hand-written pages of every site and kind."""

from __future__ import annotations

import gc
import random
from datetime import datetime
from html.parser import HTMLParser

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from townvoice.operators.normalize import default_missing
from townvoice.plans.registry import QUERIES
from townvoice.plans import webpages  # noqa: F401 - registers its queries
from townvoice.sources import pages as G
from townvoice.sources import markup
from townvoice.sources.markup import Element, parse


def page(spark, html):
    return spark.createDataFrame([(1, html)], "page_id int, html string")


def test_unclosed_and_stray_tags():
    root = parse("<div><p>a<p><b>b<br>c</div></i>d &amp; e<script>var x='</p>';</script><!-- no -->")
    assert root.text() == "abcd & e"
    assert root.first("div").text("|") == "a|b|c"
    assert [e.tag for e in root.find("div", "p", "b")] == ["b"]


def test_a_tree_is_freed_with_its_page():
    gc.collect()
    gc.disable()
    try:
        assert parse("<div><p>a<b>b</b></p></div>").first("b").text() == "b"
        assert not [e for e in gc.get_objects() if isinstance(e, Element)]
    finally:
        gc.enable()


def test_results_of_a_batch_are_handed_on_in_pieces(monkeypatch):
    monkeypatch.setattr(G, "PIECE", 40)
    seen = []

    def pick(tree):
        seen.append(tree.text())
        return {"title": tree.text()}

    batch = pa.array(["<p>" + "x" * 30, None, "<p>" + "y" * 30, "<p>z"])
    pieces = G.picked(iter([batch, batch.slice(3)]), pick, pa.struct([("title", pa.string()), ("like", pa.string())]))
    assert next(pieces).to_pylist() == [{"title": t, "like": None} for t in ("x" * 30, None, "y" * 30)]
    assert len(seen) == 2  # nothing is read ahead
    assert [len(piece) for piece in pieces] == [1, 1]


def test_a_batch_in_pieces_keeps_its_rows(spark, monkeypatch):
    monkeypatch.setattr(G, "PIECE_ROWS", 3)
    pages = spark.range(1000).coalesce(2).selectExpr("id as page_id", "case when id % 7 > 0 then concat('<title>', id, '</title>') end as html")
    rows = G.parse_generic(pages).collect()
    assert sorted((r.page_id, r.title) for r in rows) == [(i, str(i) if i % 7 else None) for i in range(1000)]


def shape(element):
    return element.tag, element.attrs, [c if isinstance(c, str) else shape(c) for c in element.children]


def test_plain_tags_are_read_without_the_library(monkeypatch):
    plain = """<DIV Class="a  b" id="q">x &lt; y<a href="/?a=1&amp;b=&quot;2" href="/z"><br>t</a></p></DIV>"""
    other = """<p x='1' y=2 z><a href="?a&copy=1">&copy</a><br/><script>"<p>"</script></ p><title>&amp;</title><td x="1"y="2"><3</td >"""
    fast = shape(parse(plain)), shape(parse(other))
    with monkeypatch.context() as m:
        for name in ("START", "END"):
            m.setattr(markup, name, markup.re.compile("(?!)"))
        assert fast == (shape(parse(plain)), shape(parse(other)))
    for name in ("parse_starttag", "parse_endtag"):
        monkeypatch.setattr(HTMLParser, name, None)
    assert shape(parse(plain)) == fast[0]


def test_a_run_of_plain_markup_is_read_in_one_go(monkeypatch):
    calls, read = [], markup._Builder.parse_starttag
    monkeypatch.setattr(markup._Builder, "parse_starttag", lambda self, i: calls.append(i) or read(self, i))
    assert len(list(parse("<ul>" + '<li class="a b">x<br>&lt;</li> ' * 500 + "</ul><p>").find("li.b.a"))) == 500
    assert len(calls) == 1


def test_any_mix_of_markup_makes_the_same_tree(monkeypatch):
    parts = ["<p>", "</p>", "<Li A='1'>", "</LI>", "<br>", "<br/>", '<a href="?x=1&amp;y" B="&copy">', "</a>", "</a >", "<title>", "</title>", "<script>",
             "</script>", "<!-- <p> -->", "<!x>", "<3", "<", ">", "&amp;", "&copy", "&", "\n", " text ", "</", '<td x="1"y="2">', "</>", '<i class="a b">', "</i>"]
    pick = random.Random(7)
    pages = ["".join(pick.choices(parts, k=pick.randrange(30))) for _ in range(3000)]
    fast = [shape(parse(page)) for page in pages]
    for name in ("START", "END", "NEXT"):
        monkeypatch.setattr(markup, name, markup.re.compile("(?!)"), raising=False)
    assert fast == [shape(parse(page)) for page in pages]


def test_results_become_arrow_columns_field_by_field():
    for kind, rows in ((G.DETAIL, [{}, {"title": "t", "comment": []}, {"comment": [{"content": "c", "blocked": True}, {}]}, {"comment": None}]),
                       (G.LISTING_ROWS, [[], [{"title": "t"}, {}], []]), (G.GENERIC, [{"links": ["a", None]}, {}]), (G.DETAIL, [])):
        made = G.column_of(rows, G.arrow_type(kind))
        made.validate(full=True)
        assert made.equals(pa.array(rows, G.arrow_type(kind)))


DC_LIST = """<table><tr class="ub-content us-post" data-no="7"><td class="gall_tit ub-word"><a href="/v?no=7"><em class="icon"></em> 제목 <b>굵게</b></a>
<a class="reply_numbox" href="#"><span class="reply_num">[1,012]</span></a></td><td class="gall_date" title="2025-02-24 10:11:12">02.24</td><td class="gall_count">조회 1,234</td></tr>
<tr class="ub-content us-post" data-no="8"><td class="gall_tit ub-word"><a href="/v?no=8">답 없음</a></td><td class="gall_date" title="2025-02-24 10:00:00">x</td><td class="gall_count">5</td></tr>
<tr class="ub-content us-post" data-no="9"><td class="gall_tit ub-word">링크 없음</td></tr>
<tr class="ub-content us-post" data-no="10"><td class="gall_tit ub-word"><a href="/v?no=10">날짜 없음</a></td><td class="gall_count">5</td></tr>
<tr class="ub-content"><td class="gall_tit ub-word"><a href="/ad">광고</a></td></tr></table>"""


def test_dcinside_listing(spark):
    got = G.parse_listing(page(spark, DC_LIST), "dcinside").orderBy("pos").collect()
    assert [(r.title, r.url, r.post_id, r.comment_count, r.view, r.created_at) for r in got] == [
        ("제목 굵게", "https://gall.dcinside.com/v?no=7", "7", 1012, 1234, datetime(2025, 2, 24, 10, 11, 12)),
        ("답 없음", "https://gall.dcinside.com/v?no=8", "8", 0, 5, datetime(2025, 2, 24, 10)),
    ]


CLIEN_ROW = """<div class="list_item symph_row jirum" data-board-sn="11"><a class="subject_fixed" href="/s/11">글</a><span class="rSymph05">3</span>
<span class="hit">12.3 k</span><span class="timestamp">2025-02-24 01:02:03</span></div>"""


def test_clien_listing(spark):
    row = G.parse_listing(page(spark, '<a class="board-nav-page active">1</a>' + CLIEN_ROW), "clien").first()
    assert (row.url, row.post_id, row.comment_count, row.view, row.status) == ("https://www.clien.net/s/11", "11", 3, 12300, "CHANGED")
    # Beyond the last page the site repeats rows without an active page number.
    assert G.parse_listing(page(spark, CLIEN_ROW), "clien").count() == 0


def bobae_row(category, number, date="25. 02. 14"):
    return f'<li><dl><dt><a href="/view?code=x&amp;No={number}"> 글 </a></dt><dd class="path"><span>{category}</span><span>w</span><span>{date}</span></dd></dl></li>'


def test_bobaedream_listing(spark):
    rows = bobae_row("국산차게시판", 1) + bobae_row("news", 2) + "<li><dl><dt>링크 없음</dt></dl></li>" + bobae_row("자유게시판", 3, "어제")
    got = G.parse_listing(page(spark, f'<div class="search_Community"><ul>{rows}</ul></div>'), "bobaedream").collect()
    assert [(r.post_id, r.title, r.url, r.view, r.comment_count, r.created_at) for r in got] == [
        ("m1", "글", "https://www.bobaedream.co.kr/view?code=x&No=1", -999, -999, datetime(2025, 2, 14)),
    ]


def test_dcinside_detail_with_defaults(spark):
    html = """<title> 제목 </title><div class="write_div"> 본문 </div><p class="up_num">9</p><div class="up_num_box"><p class="up_num">4</p></div>
    <ul><li class="ub-content"><div class="clear cmt_txtbox"><p class="usertxt ub-word"> 댓글 </p></div></li></ul>"""
    details = G.parse_detail(page(spark, html), "dcinside").withColumns({"platform": F.lit("dcinside"), "url": F.lit("/7")})
    row = details.first()
    assert (row.title, row.content, row.view, row.like, row.dislike, row.comment_count) == ("제목", "본문", None, 4, 0, None)
    tracking = spark.createDataFrame(
        [("dcinside", "/7", 5, 6, datetime(2025, 1, 1))], "platform string, url string, view int, comment_count int, created_at timestamp_ntz"
    )
    full = default_missing(details, tracking).first()
    assert (full.view, full.comment_count, full.created_at) == (5, 6, datetime(2025, 1, 1))
    assert [(c.content, c.created_at, c.like) for c in full.comment] == [("댓글", datetime(2025, 1, 1), None)]
    empty = default_missing(G.parse_detail(page(spark, "<p>"), "dcinside").withColumns({"platform": F.lit("dcinside"), "url": F.lit("/7")}), tracking).first()
    assert (empty.title, empty.content, empty.like, empty.comment) == ("제목 없음", "본문 없음", 0, [])


def test_clien_detail(spark):
    html = """<h3 class="post_subject"><span>제목</span><span>x</span></h3><div class="post_article"><p>첫<br>줄</p> <p>둘</p></div>
    <div class="post_author"><span class="view_count">조회 <strong>1,234</strong></span></div><a class="symph_count"><strong>5</strong></a>
    <a class="post_reply"><span>3</span></a>
    <div class="comment_row"><div class="comment_view">좋다<br>정말</div><span class="timestamp">2025-02-24 01:02:03 / 수정일: 2025-02-25 00:00:00</span>
      <div class="comment_content_symph"><strong>2</strong></div></div>
    <div class="comment_row blocked"><div class="comment_view">차단</div></div>
    <div class="comment_row"><div class="comment_view">또</div><span class="timestamp">2025-02-24 02:00:00</span></div>"""
    row = G.parse_detail(page(spark, html), "clien").first()
    assert (row.title, row.content, row.view, row.like, row.dislike, row.comment_count) == ("제목", "첫\n줄\n둘", 1234, 5, None, 3)
    assert [(c.content, c.created_at, c.like, c.dislike) for c in row.comment] == [
        ("좋다\n정말", datetime(2025, 2, 24, 1, 2, 3), 2, None), ("또", datetime(2025, 2, 24, 2), 0, None),
    ]


def test_bobaedream_detail(spark):
    comment = """<li><dl><dt><span>a</span><span>b</span><span>c</span><span>25.02.14 05:09</span></dt><dd> 좋아요 </dd></dl>
    <div class="updownbox"><dl><dd>추천 3</dd><dd>반대 1</dd></dl></div></li>"""
    html = f"""<div class="writerProfile"><dl><dt title="제목">x</dt><dd><span class="countGroup">조회 <em>1,234</em> | <em>x</em>추천 <em>7</em> | 2025.02.14 (금) 05:09</span></dd></dl></div>
    <div class="bodyCont">\n a b\n\n\nc  \n</div><div id="cmt_list"><ul class="basiclist">{comment}<li>삭제된 댓글입니다.</li><li>형식 오류</li></ul></div>"""
    row = G.parse_detail(page(spark, html), "bobaedream").first()
    assert (row.title, row.content, row.view, row.like, row.dislike, row.comment_count) == ("제목", "a b\nc", 1234, 7, None, 3)
    assert row.created_at == datetime(2025, 2, 14, 5, 9)
    assert [(c.content, c.created_at, c.like, c.dislike) for c in row.comment] == [("좋아요", datetime(2025, 2, 14, 5, 9), 3, 1), (None, None, None, None)]
    bare = G.rejected_detail(page(spark, "<div class='bodyCont'>x</div>"), "bobaedream").first()
    assert (bare.content, bare.title, bare.comment_count, bare.comment) == ("x", None, 0, [])


@pytest.mark.parametrize("counts, view, like", [
    ("조회 <em>많음</em> | <em>x</em>추천 <em>7</em>", -999, 7), ("조회", -999, -999), ("조회 <em>12</em> | <em>x</em>", 12, -999),
    ("조회 <em>12</em> | <em>x</em>추천 <em>없음</em>", 12, None),
])
def test_counts_that_a_bobaedream_page_does_not_show_are_not_known(spark, counts, view, like):
    html = f"""<div class="writerProfile"><dl><dt title="제목">x</dt><span class="countGroup">{counts} | 어제</span></dl></div><div class="bodyCont">x</div>"""
    row = G.parse_detail(page(spark, html), "bobaedream").first()
    assert (row.view, row.like, row.created_at, row.comment_count) == (view, like, None, 0)


@pytest.mark.parametrize("site, html, kept", [
    ("bobaedream", '<div class="writerProfile"><dl><dt title="t"></dt></dl></div>', False), ("bobaedream", None, False),
    ("clien", '<h3 class="post_subject"><span>t</span></h3>', False), ("clien", '<div class="post_article">x</div>', False),
    ("clien", '<h3 class="post_subject"><span>t</span></h3><div class="post_article">x</div>', True),
    ("dcinside", "", True), ("dcinside", None, False),
])
def test_pages_without_heading_or_body_are_rejected(spark, site, html, kept):
    assert (G.parse_detail(page(spark, html), site).count(), G.rejected_detail(page(spark, html), site).count()) == (int(kept), int(not kept))


def test_generic(spark):
    html = "<title>T &amp; t</title><a href='/x'>x</a><article><h1>T</h1><p>one<br>two<p>three</article><a>no link</a>"
    row = G.parse_generic(page(spark, html)).first()
    assert (row.title, row.content, row.links) == ("T & t", "T\none\ntwo\nthree", ["/x"])
    assert G.parse_generic(page(spark, None)).first().title is None


@pytest.mark.parametrize("name", ["parse_generic", *[f"parse_{kind}_{site}" for kind in ("listing", "detail") for site in G.HOSTS]])
def test_every_page_is_parsed_once(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
