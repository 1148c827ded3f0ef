"""Column functions for the time formats of the sites and for batch times.

Everything stays a zone-less timestamp, so no result depends on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BATCH_FORMAT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"

# layout -> (what the text looks like, how to write it as yyyy-MM-dd HH:mm:ss)
LAYOUTS = {
    "seconds": (r"^[\s\S]*?(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})[\s\S]*$", "$1"),
    "date": (r"^(\d{2})\. *(\d{1,2})\. *(\d{1,2})$", "20$1-$2-$3 00:00:00"),
    "weekday": (r"^(\d{4})\.(\d{1,2})\.(\d{1,2}) (\d{1,2}:\d{1,2})$", "$1-$2-$3 $4:00"),
    "minutes": (r"^(\d{2})\.(\d{1,2})\.(\d{1,2}) (\d{1,2}:\d{1,2})$", "20$1-$2-$3 $4:00"),
}


def ntz(literal: str) -> Column:
    return F.lit(literal).cast("timestamp_ntz")


def clean_date_text(c: Column) -> Column:
    """Drop ``&nbsp;`` and the weekday, squeeze whitespace."""
    text = F.replace(c, F.lit("&nbsp;"), F.lit(" "))
    text = F.regexp_replace(text, r"\([월화수목금토일]\)", "")
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def parse_community_ts(c: Column, layout: str) -> Column:
    """Text in one of the four site layouts as a timestamp, NULL if it does not fit."""
    pattern, iso = LAYOUTS[layout]
    text = clean_date_text(c) if layout == "weekday" else F.trim(c)
    fits = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, iso))
    return fits.try_cast("timestamp_ntz")


def batch_ts(c: Column) -> Column:
    """Batch time from ``yyyy-MM-ddTHH:mm:ss``; another format fails the job."""
    problem = F.concat(F.lit("batch time must look like yyyy-MM-ddTHH:mm:ss: "), c)
    valid = F.when(c.rlike(BATCH_FORMAT), c.try_cast("timestamp_ntz"))
    return F.coalesce(valid, F.raise_error(problem).cast("timestamp_ntz"))


def batch_path(ts: Column) -> Column:
    """Directory of a batch, ``yyyy-MM-dd/H/m`` with unpadded hour and minute."""
    return F.concat_ws("/", F.to_date(ts).cast("string"), F.hour(ts).cast("string"), F.minute(ts).cast("string"))


def utc_now() -> Column:
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def to_kst(c: Column, now: Column | None = None) -> Column:
    """UTC to Korean local time; rows without a time get the current one."""
    return F.coalesce(c, utc_now() if now is None else now) + F.expr("INTERVAL 9 HOURS")


def crawl_window(now: Column, days_back: int = 3, days_ahead: int = 1) -> list[Column]:
    """checked_at, start_date and end_date of a crawl that starts at ``now``."""
    return [
        now.alias("checked_at"),
        F.date_sub(F.to_date(now), days_back).alias("start_date"),
        F.date_add(F.to_date(now), days_ahead).alias("end_date"),
    ]


def truncate(ts: Column, unit: str) -> Column:
    """Start of the hour or day, without leaving the zone-less type."""
    day = F.to_date(ts).cast("timestamp_ntz")
    if unit == "day":
        return day
    if unit == "hour":
        return day + F.make_dt_interval(hours=F.hour(ts))
    raise ValueError(f"unit must be hour or day, not {unit!r}")
