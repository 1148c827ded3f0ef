"""Column functions that clean and type scraped text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What the sites write around a count.
COUNT_LABELS = ("조회 ", "댓글 ", "추천 ", "반대 ")
SI_FACTORS = {"k": 1e3, "M": 1e6, "G": 1e9}
NO_KEYWORD = "no_keyword"

# Post ids are only unique within a board, so each board has a letter.
BOARD_LETTERS = {
    "베스트글": "a", "자유게시판": "b", "정치게시판": "c", "시승기·배틀·목격담": "d",
    "유명인의 차": "e", "자동차뉴스": "f", "보배드림 이야기": "g", "제안·건의": "h",
    "이벤트": "i", "유머게시판": "j", "교통사고·블박": "k", "국산차게시판": "m",
    "수입차게시판": "n", "내차사진": "l", "직찍·특종발견": "o",
    "자동차사진·동영상": "p", "장착시공사진": "q", "자유사진·동영상": "r",
    "레이싱모델": "s", "군사·무기": "t", "트럭·버스·중기": "u",
    "항공·해운·철도": "v", "오토바이·자전거": "w", "올드카·추억거리": "x",
}


def literal_map(mapping: dict) -> Column:
    """A constant map column; folded once per query, not per row."""
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind, not just spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def lenient_int(c: Column) -> Column:
    """Integer text as a number, anything else as NULL."""
    return strip(c.cast("string")).try_cast("bigint")


def strict_int(c: Column) -> Column:
    """Integer text as a number; anything else, NULL included, fails the job."""
    number = lenient_int(c)
    problem = F.concat(F.lit("not an integer: "), F.coalesce(c.cast("string"), F.lit("NULL")))
    return F.coalesce(number, F.raise_error(problem).cast("bigint"))


def parse_count(c: Column, missing: int = 0) -> Column:
    """``조회 1,234`` or ``[12]`` as a number; ``missing`` where the element is absent."""
    bare = reduce(lambda text, label: F.replace(text, F.lit(label), F.lit("")), COUNT_LABELS, strip(c))
    bare = F.translate(bare, "[],", "")
    return F.when(c.isNull(), F.lit(missing).cast("bigint")).otherwise(strip(bare).try_cast("bigint"))


def parse_si_count(c: Column) -> Column:
    """``12.3 k`` as 12300. The factor follows a space; an unknown one gives NULL."""
    parts = F.split(c, " ")
    number = F.get(parts, F.lit(0)).try_cast("double")
    factor = F.try_element_at(literal_map(SI_FACTORS), F.get(parts, F.lit(1)))
    return F.when(F.size(parts) > 1, number * factor).otherwise(number).try_cast("bigint")


def clean_content(c: Column) -> Column:
    """Trim, turn no-break spaces into spaces, collapse runs of line breaks."""
    spaced = F.replace(strip(c), F.lit("\xa0"), F.lit(" "))
    return F.regexp_replace(spaced, "\n{2,}", "\n")


def join_keywords(c: Column) -> Column:
    """Trimmed keywords joined by ``-``."""
    words = F.coalesce(c, F.array(F.lit(NO_KEYWORD)))
    return F.array_join(F.transform(words, strip), "-")


def unique_keywords(c: Column) -> Column:
    """Keywords without duplicates, first occurrence first."""
    return F.array_distinct(c)


def post_id_from_url(c: Column, marker: str = "No=") -> Column:
    """The text between the first and second marker; NULL if there is none."""
    return F.get(F.split(c, marker), F.lit(1))


def absolute_url(host: str, path: Column) -> Column:
    return F.concat(F.lit(host), path)


def board_letter(category: Column, letters: dict[str, str] | None = None) -> Column:
    return F.try_element_at(literal_map(letters or BOARD_LETTERS), category)
