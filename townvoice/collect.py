"""The collecting half: listing pages into the tracking table, detail pages into the landing.

``search`` reads result listings and folds their hits into the stored tracking table.
``detail`` claims URLs that wait, reads their pages, attaches labels and lands them: posts and
comments together or not at all, one log row per batch and platform, and URLs given back where
a landing fails. Fetching pages and asking for labels happen elsewhere; both come as tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.times import ntz, utc_now
from .operators.listing import category_filter, drop_repeated_pages, listing_window
from .operators.normalize import crawl_state, fill_missing
from .operators.planning import append_run_log, run_log
from .operators.sentiment import put_labels, reply_labels
from .schemas import HITS_SCHEMA, NESTED_SCHEMA, NOT_KNOWN
from .session import materialize, scratch
from .sources import landing as L
from .sources import tracking_table as store
from .sources.pages import HOSTS, detail_rows, parse_listing, rejected_listing

PAGE_ROWS = 100_000  # rows of a listing page, at most, in the numbers that order hits
# What the URLs of a landing that failed become, by site. Fixed values; others are crawled again.
GIVEN_BACK = {"bobaedream": "CHANGED", "dcinside": "FAILED"}


def search_hits(pages: DataFrame, checked_at: str, start: Column | None = None, end: Column | None = None, mode: str = "take_while") -> DataFrame:
    """Hits of listing pages (platform, keyword, page, html), in the order of page and place.

    A listing ends at the first row older than ``start`` (``take_while``), and where a page
    shows the posts of the page before. Blocked boards are left out. Rows that cannot be read
    are in :func:`search_rejects`.
    """
    listed = None
    for site in HOSTS:
        rows = parse_listing(_of(pages, site), site).withColumn("pos", F.col("page").cast("bigint") * PAGE_ROWS + F.col("pos"))
        listed = rows if listed is None else listed.unionByName(rows)
    # written once: the rules below look at the rows several times, and a page is parsed once
    listed = materialize(listed.withColumnRenamed("platform", "source"), "listed")
    paged = listed.filter(F.col("source") == "dcinside")
    rows = drop_repeated_pages(paged).unionByName(category_filter(listed.filter(F.col("source") == "bobaedream")))
    rows = rows.unionByName(listed.filter(~F.col("source").isin("dcinside", "bobaedream")))
    if start is not None:
        rows = listing_window(rows, start, end if end is not None else ntz("9999-12-31 00:00:00"), mode)
    return rows.select(
        F.col("source").alias("platform"), "url", "post_id", "status",
        *[F.col(name).cast("int").alias(name) for name in ("comment_count", "view")],
        "created_at", ntz(checked_at.replace("T", " ")).alias("checked_at"), "keyword", F.col("pos").alias("seq")).select(*HITS_SCHEMA.names)


def search_rejects(pages: DataFrame) -> DataFrame:
    """Listing rows whose counts or time cannot be read."""
    found = None
    for site in HOSTS:
        rows = rejected_listing(_of(pages, site), site)
        found = rows if found is None else found.unionByName(rows)
    return found


def search(spark: SparkSession, pages: DataFrame, table: str, checked_at: str, start: Column | None = None, end: Column | None = None,
           threshold: int = 100, rule: str = "literal") -> DataFrame:
    """Fold the hits of listing pages into the stored tracking table; returns the rows they touch."""
    with scratch(f"{table}/scratch"):
        return store.upsert_table(spark, table, search_hits(pages, checked_at, start, end), threshold, rule)


def _of(pages: DataFrame, site: str) -> DataFrame:
    return pages.filter(F.col("platform") == site)


def nested_details(claimed: DataFrame, pages: DataFrame, replies: DataFrame | None = None, lenient: bool = False) -> tuple[DataFrame, DataFrame]:
    """Claimed URLs joined to their pages (platform, url, html): (posts as landed, outcome of every URL).

    Outcomes: ``read``; ``banned`` (a page without content, as a refused request leaves one);
    ``failed`` (no heading or body); ``unseen`` (no page). Each page is parsed once. What a post
    takes from its crawl state and its reply goes along with the claimed URL, so that the texts
    are written once and take part in no join.
    """
    wanted = claimed.select("platform", "url", "post_id", "keywords", *crawl_state(), F.lit(True).alias("_claimed"))
    if replies is not None:
        # written once, so that its size is known when it meets the pages: they stay in place beside a small one
        wanted = materialize(wanted.join(reply_labels(replies, lenient=lenient), ["platform", "post_id"], "left"), "wanted")
    given = pages.select("platform", "url", "html", F.lit(True).alias("_fetched"))
    paired = wanted.join(given, ["platform", "url"], "left")
    unseen = paired.filter(F.col("_fetched").isNull()).select("platform", "url", F.lit("unseen").alias("outcome"))
    fetched = paired.filter("_fetched").drop("_fetched", "_claimed")
    # Refused pages go along with nothing to read, those of further platforms with the first site's:
    # which they are comes out of the same pass.
    refused = ~F.col("platform").isin(*HOSTS) & F.col("html").isNull()
    rows = None
    for site in HOSTS:
        own = F.col("platform") == site
        each = detail_rows(fetched.filter(own if rows is not None else own | refused).withColumn("_shown", F.col("html").isNotNull()), site)
        rows = each if rows is None else rows.unionByName(each)
    posts = fill_missing(rows.withColumn("_comment", F.col("comment")))
    # one site shows no comment times; elsewhere a comment without one was deleted
    posts = posts.withColumn("comment", F.when(F.col("platform") == "dcinside", F.col("comment")).otherwise(F.col("_comment"))).drop("_comment")
    posts = posts.withColumns({
        "sentiment": F.lit(None).cast("string"), "status": F.lit("UNCHANGED"),
        **{name: F.coalesce(F.col(name), F.lit(NOT_KNOWN)).cast("string") for name in ("view", "comment_count")},
        **{name: F.col(name).cast("string") for name in ("like", "dislike")},
        "comment": F.transform("comment", lambda c: c.withField("like", c["like"].cast("string")).withField("dislike", c["dislike"].cast("string"))),
    })
    if replies is not None:
        posts = put_labels(posts)
    parsed = materialize(posts.select("_readable", "_shown", "platform", *NESTED_SCHEMA.names), "details")
    posts = parsed.filter("_readable").drop("_readable", "_shown")
    outcome = F.when(~F.col("_shown"), "banned").when(~F.col("_readable"), "failed").otherwise("read")
    return posts, parsed.select("platform", "url", outcome.alias("outcome")).unionByName(unseen)


def land_batch(spark: SparkSession, nested: DataFrame, root: str, checked_at: str, platform: str | None, id: str, table: str | None = None,
               log: str | None = None, bucket: str = "landing", keywords: str = "no_keyword", style: str = "actual", now: Column | None = None) -> None:
    """Land a batch; log it once; where it fails, give its URLs back in ``table`` and raise.

    A batch that lands again, after a failure or a crash, adds no second log row.
    """
    name = L.landing_name(id, platform)
    try:
        L.land_nested(nested, root, checked_at, platform, id)
    except Exception:
        if table is not None:
            recover(spark, root, checked_at, table, name)
        raise
    if log is not None:
        run = spark.createDataFrame([(checked_at, keywords, platform, id)], "checked_at string, keywords_str string, platform string, id string")
        run = run.withColumn("checked_at", F.to_timestamp_ntz("checked_at", F.lit("yyyy-MM-dd'T'HH:mm:ss")))
        append_run_log(spark, log, run_log(run, bucket, utc_now() if now is None else now, style))


def recover(spark: SparkSession, root: str, checked_at: str, table: str, name: str | None = None) -> list[str]:
    """Give back the URLs of landings that began and were never complete; returns their names.

    For landings that raised, and for those whose process died. Once given back they are
    noted, so that a later call leaves them alone.
    """
    open_ = L.landings(spark, f"{root}/{L.batch_dir(checked_at)}").filter("state = 'begun'")
    done = []
    for row in (open_ if name is None else open_.filter(F.col("name") == name)).collect():
        urls = L.unfinished_urls(spark, root, checked_at, row.name)
        status = F.lit("CHANGED")
        for site, given in GIVEN_BACK.items():
            status = F.when(F.col("platform") == site, given).otherwise(status)
        changes = urls.distinct().select("platform", "url", status.alias("status"), F.lit(None).cast("timestamp_ntz").alias("checked_at"), F.lit(1).alias("seq"))
        store.transition_table(spark, table, changes)
        L.rolled_back(spark, root, checked_at, row.name, row.platform, row.attempt)
        done.append(row.name)
    return done


def detail(spark: SparkSession, pages: DataFrame, table: str, root: str, checked_at: str, id: str, replies: DataFrame | None = None,
           limit: int | None = None, log: str | None = None, bucket: str = "landing", keywords: str = "no_keyword", lenient: bool = False, now: Column | None = None) -> DataFrame:
    """Claim, read, label and land; returns the ``outcome`` of every claimed URL.

    Read pages refresh the stored state and stay UNCHANGED, unread ones become FAILED, refused
    ones BANNED, and URLs without a page wait again. Platforms land apart: one that fails has
    its URLs given back and the others land; the first failure is raised at the end.
    """
    time = ntz(checked_at.replace("T", " "))
    claimed = materialize(store.claim_table(spark, table, time, limit), "claimed")
    posts, outcomes = nested_details(claimed, pages, replies, lenient)
    outcomes = materialize(outcomes, "outcomes")
    figures = posts.select("platform", "url", *[F.col(name).cast("int").alias(name) for name in ("comment_count", "view")], "created_at", F.lit(1).alias("seq"))
    store.refresh_table(spark, table, figures)
    status = F.create_map(*map(F.lit, ("failed", "FAILED", "banned", "BANNED", "unseen", "CHANGED")))[F.col("outcome")]
    when = F.when(F.col("outcome") != "unseen", time)
    store.transition_table(spark, table, outcomes.filter("outcome <> 'read'").select(
        "platform", "url", status.alias("status"), when.alias("checked_at"), F.lit(1).alias("seq")))
    problems = []
    for site in HOSTS:
        own = _of(posts, site)
        if own.isEmpty():
            continue
        try:
            land_batch(spark, own.drop("platform"), root, checked_at, site, id, table, log, bucket, keywords, now=now)
        except Exception as problem:  # noqa: BLE001 - the other platforms land first
            problems.append(problem)
    if problems:
        raise problems[0]
    return outcomes
