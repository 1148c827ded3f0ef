"""Golden rows of the column functions."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from townvoice.functions import replies as R
from townvoice.functions import text as X
from townvoice.functions import times as D


def test_lenient_int(column):
    assert column(X.lenient_int, ["7", "1,234", None, " 8\n", "7.5", "x", "-3", ""]) == [7, None, None, 8, None, None, -3, None]


def test_strict_int_fails_the_job(column):
    assert column(X.strict_int, ["7", " 12 "]) == [7, 12]
    with pytest.raises(Exception, match="not an integer"):
        column(X.strict_int, ["1,234"])
    with pytest.raises(Exception, match="not an integer"):
        column(X.strict_int, ["1", None])


def test_parse_count(column):
    values = ["조회 1,234", "[12]", "댓글 7", "추천 3", "반대 0", None, "많음", " 5 "]
    assert column(X.parse_count, values) == [1234, 12, 7, 3, 0, 0, None, 5]


def test_parse_si_count(column):
    assert column(X.parse_si_count, ["12.3 k", "950", "1 M", "2 G", "3 x", "n", None]) == [12300, 950, 1000000, 2000000000, None, None, None]


@pytest.mark.parametrize("layout, text, expected", [
    ("date", "25. 02. 14", datetime(2025, 2, 14)),
    ("weekday", "2025.02.14&nbsp;(금) 05:09", datetime(2025, 2, 14, 5, 9)),
    ("weekday", "2025.02.14 (금)  05:09", datetime(2025, 2, 14, 5, 9)),
    ("minutes", "25.02.14 05:09", datetime(2025, 2, 14, 5, 9)),
    ("seconds", "2025-02-14 05:09:01", datetime(2025, 2, 14, 5, 9, 1)),
    ("seconds", "2025-02-14 05:09:01 / 수정일: 2025-03-01 00:00:00", datetime(2025, 2, 14, 5, 9, 1)),
    ("date", "어제", None),
    ("seconds", "2025-02-30 05:09:01", None),
    ("minutes", "2025", None),
    ("weekday", None, None),
])
def test_parse_community_ts(column, layout, text, expected):
    assert column(lambda c: D.parse_community_ts(c, layout), [text]) == [expected]


def test_clean_content(column):
    assert column(X.clean_content, ["\n a\xa0b\n\n\nc \xa0\n", None]) == ["a b\nc", None]


def test_clean_date_text(column):
    assert column(D.clean_date_text, [" 2025.02.14&nbsp;(금)\t 05:09 "]) == ["2025.02.14 05:09"]


def test_join_keywords(column):
    got = column(X.join_keywords, [[" 벤츠 ", "화재"], None, ["a\n"]], "array<string>")
    assert got == ["벤츠-화재", "no_keyword", "a"]


def test_unique_keywords(column):
    assert column(X.unique_keywords, [["b", "a", "b"]], "array<string>") == [["b", "a"]]


def test_post_id_from_url(column):
    assert column(X.post_id_from_url, ["/view?code=x&No=123", "/view"]) == ["123", None]


def test_board_letters(column):
    assert column(X.board_letter, ["국산차게시판", "news", "내차사진"]) == ["m", None, "l"]
    assert len(set(X.BOARD_LETTERS.values())) == 24


def test_batch_path(column):
    to_path = lambda c: D.batch_path(D.batch_ts(c))
    assert column(to_path, ["2025-02-24T03:05:03", "2025-12-31T23:59:59"]) == ["2025-02-24/3/5", "2025-12-31/23/59"]
    with pytest.raises(Exception, match="batch time must look like"):
        column(to_path, ["2025-02-24 03:05"])


def test_to_kst(column):
    got = column(lambda c: D.to_kst(c, D.ntz("2025-01-01 00:00:00")), [datetime(2025, 2, 24, 20), None], "timestamp_ntz")
    assert got == [datetime(2025, 2, 25, 5), datetime(2025, 1, 1, 9)]
    assert column(D.to_kst, [None], "timestamp_ntz")[0] is not None


def test_crawl_window(spark):
    row = spark.range(1).select(*D.crawl_window(D.ntz("2025-03-01 10:00:00"))).first()
    assert tuple(row) == (datetime(2025, 3, 1, 10), date(2025, 2, 26), date(2025, 3, 2))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Seoul"])
def test_results_do_not_depend_on_the_session_zone(spark, column, zone):
    """2025-03-09 02:30 does not exist in New York; zone-less times do not care."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert column(lambda c: D.parse_community_ts(c, "seconds"), ["2025-03-09 02:30:00"]) == [datetime(2025, 3, 9, 2, 30)]
        at = [datetime(2025, 3, 9, 2, 30)]
        assert column(lambda c: D.truncate(c, "hour"), at, "timestamp_ntz") == [datetime(2025, 3, 9, 2)]
        assert column(D.batch_path, at, "timestamp_ntz") == ["2025-03-09/2/30"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_strip_json_fence(column):
    assert column(R.strip_json_fence, ['\n```json\n{"a": 1}\n```\n', '{"a": 1}']) == ['{"a": 1}', '{"a": 1}']


FULL = '{"게시글_감정": "negative", "댓글_분석": [{"내용": "x", "감정": "positive"}, {"감정": "neutral"}]}'


@pytest.mark.parametrize("reply, lenient, label, comments", [
    (FULL, False, "negative", ["positive", "neutral"]),
    ("```json\n" + FULL + "\n```", False, "negative", ["positive", "neutral"]),
    ("sorry", False, None, None),
    ("{}", False, None, None),
    ("[1]", False, None, None),
    (None, False, None, None),
    ('{"x": 1}', False, "neutral", None),
    ('{"게시글_감정": null}', False, None, None),
    ('{"게시글 감정": "negative"}', False, "neutral", None),
    ('{"게시글 감정": "negative"}', True, "negative", None),
    ('{"게시글_감정": "postive"}', False, "postive", None),
    ('{"게시글_감정": "postive", "댓글_분석": [{"감정": "postive"}]}', True, "positive", ["positive"]),
    ('{"게시글_감정": "negative"', False, None, None),
])
def test_parse_sentiment_json(column, reply, lenient, label, comments):
    got = column(lambda c: R.parse_sentiment_json(c, lenient), [reply])[0]
    assert (got.label, got.comments) == (label, comments)


def test_sentiment_prompt(spark):
    comment = F.array(F.struct(F.lit("좋다").alias("content")), F.struct(F.lit("별로").alias("content")))
    text = spark.range(1).select(R.sentiment_prompt(F.lit(None).cast("string"), F.lit("본문글"), comment, "신차").alias("p")).first().p
    assert text.startswith("신차에 대한") and text.endswith("제목: 제목 없음\n본문: 본문글\n댓글:\n- 좋다\n- 별로")


def test_whitespace_is_what_python_strips():
    assert set(X.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
