"""Crawl state: one row per (platform, url), changed only by the operators here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import TRACKING_SCHEMA
from ..session import materialize
from .fold import BASE, CHAIN, COLUMNS, FINAL_SCHEMA, FORCED, HIT, INTERVALS, OUTCOME_SCHEMA, PACKED, chain_outcomes, fold_ranges

KEY = ["platform", "url"]
UNSTABLE = ["FAILED", "BANNED"]
STATE = ["status", "comment_count", "created_at", "checked_at", "view"]


def tracking_lookup(hits: DataFrame, tracking: DataFrame) -> DataFrame:
    """Each hit with the current state of its URL, NULL for a new URL.

    With a stored ``tracking`` both sides are shuffled for the join alone, which lets
    adaptive execution split a URL with most of the hits.
    """
    state = tracking.select(*KEY, *[F.col(name).alias(f"known_{name}") for name in ("keywords", *STATE)])
    return hits.join(state, KEY, "left")


def same_key(left: str, right: str) -> Column:
    return F.col(f"{left}.platform").eqNullSafe(F.col(f"{right}.platform")) & (F.col(f"{left}.url") == F.col(f"{right}.url"))


def tracking_upsert(tracking: DataFrame | None, hits: DataFrame, threshold: int = 100, rule: str = "literal", touched_only: bool = False) -> DataFrame:
    """The tracking table after applying ``hits`` in (checked_at, seq) order.

    ``touched_only`` returns the rows of URLs with a hit and leaves the others out.

    Equal times and numbers are ordered by the remaining fields, so the order of the input
    never matters.

    A new URL needs a hit with all fields. A known one takes status and time of a FAILED
    or BANNED hit, and all figures of a hit that fires: views fell by more than
    ``threshold``, fewer comments, or a new keyword (``rule="documented"``: views or
    comments differ in either direction). Other hits leave no trace.

    The first hit of each (url, keyword) is a plain minimum, so keywords never enter the
    ordered part. That part runs over ranges of (url, time): a URL with most of the hits
    is cut into many ranges, folded independently and combined from their few outcomes.
    Without such a URL it runs over whole URLs, spread by hash.
    """
    if threshold < 0 or rule not in ("literal", "documented"):
        raise ValueError("threshold must not be negative, rule must be literal or documented")
    figures = [F.col(name).isNotNull() for name in ("comment_count", "view", "created_at", "keyword")]
    has_figures = figures[0] & figures[1] & figures[2] & figures[3]
    unstable = F.col("status").isin(UNSTABLE)
    known = hits.filter(
        F.col("url").isNotNull() & F.col("checked_at").isNotNull() & F.col("status").isNotNull() & (unstable | has_figures)
    )
    own = F.struct(F.col("checked_at").alias("at"), F.coalesce("seq", F.lit(0)).alias("seq"), *STATE, "post_id")
    insertable, sighted = F.col("post_id").isNotNull(), ~unstable & (F.col("keyword") != "")
    # A small table, one row per (url, keyword), used several times below.
    seen = materialize(
        known.groupBy(*KEY, "keyword").agg(
            F.min(F.when(has_figures & insertable, own)).alias("insert"),
            F.min(F.when(has_figures & sighted, own)).alias("any"),
            F.min(F.when(has_figures & sighted & insertable, own)).alias("full"),
            F.count(F.lit(1)).alias("hits"),
        ),
        "sightings",
    )
    of_urls = seen.groupBy(*KEY).agg(F.sum("hits").alias("hits"))
    most, total = (n or 0 for n in of_urls.agg(F.max("hits"), F.sum("hits")).first())
    touched = untouched = None
    if tracking is not None:
        # URLs without a hit keep their row and stay out of the fold.
        urls = seen.select(*KEY).distinct().alias("u")
        touched = tracking.alias("t").join(urls, same_key("t", "u"), "left_semi")
        untouched = tracking.alias("t").join(urls, same_key("t", "u"), "left_anti")
    strays = seen.filter(F.col("any").isNotNull() & ~F.col("any").eqNullSafe(F.col("full")))
    if strays.isEmpty():  # the usual case: every hit has its post_id
        per_keyword = seen.withColumn("late", F.col("full")).alias("s")
    else:
        late = late_sightings(known.filter(sighted & ~insertable).withColumn("own", own), seen)
        per_keyword = seen.alias("s").join(
            late.alias("l"), same_key("s", "l") & (F.col("s.keyword") == F.col("l.keyword")), "left"
        )
    found = per_keyword.groupBy("s.platform", "s.url").agg(
        F.min_by(F.struct("insert", F.array("s.keyword").alias("keywords")), "insert").alias("first"),
        F.collect_list(F.struct("s.keyword", "any", "full", "late")).alias("sightings"),
    )
    order = [F.col(name).asc_nulls_first() for name in (*KEY, "at", "seq", "kind", *STATE, "post_id", "blank")]
    hit_rows = known.withColumn("own", own).select(
        *KEY, F.lit(HIT).alias("kind"), "own.*", F.coalesce(F.col("keyword") == "", F.lit(False)).alias("blank"),
        F.lit(None).cast("string").alias("words"),
    )
    stream = start_rows(touched, found).select(*COLUMNS).unionByName(hit_rows.select(*COLUMNS))
    partitions = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # where no URL has more hits than an even range, URLs stay whole: ranges would be found by a pass of their own
    whole = most * partitions <= total
    placed = stream.repartition(*KEY) if whole else stream.repartitionByRange(*order)
    outcomes = placed.sortWithinPartitions(*order).mapInPandas(fold_ranges(threshold, rule == "documented"), OUTCOME_SCHEMA)
    # a range leaves three rows of a URL, and one for every full row of intervals
    ranges = 1 if whole else min(most, partitions)
    folded = final_state(outcomes, threshold, rule, most=3 * ranges + most // PACKED)
    if untouched is None or touched_only:
        return folded
    kept = untouched.withColumn("keywords", F.array_distinct("keywords")).select(*TRACKING_SCHEMA.names)
    return folded.unionByName(kept)


def late_sightings(strays: DataFrame, seen: DataFrame) -> DataFrame:
    """First sightings among hits that cannot insert, where some came before the insert.

    Only a hit after its URL is known counts. The plain minimum answers that unless it
    lies before the insert; for those few (url, keyword) the hits are looked at again.
    """
    known_from = F.min("insert").over(Window.partitionBy(*KEY))
    early = seen.withColumn("known_from", known_from).filter(F.col("any") < F.col("known_from"))
    return (
        strays.alias("h")
        .join(early.alias("e"), same_key("h", "e") & (F.col("h.keyword") == F.col("e.keyword")))
        .filter(F.col("h.own") > F.col("known_from"))
        .groupBy("h.platform", "h.url", "h.keyword")
        .agg(F.min("h.own").alias("late"))
    )


def start_rows(tracking: DataFrame | None, found: DataFrame) -> DataFrame:
    """The rows every URL's fold is sure of: its first state and its new keywords."""
    figures = ["at", "seq", *STATE, "post_id"]
    if tracking is None:
        both = found.select(*KEY, F.lit(None).cast("int").alias("stored"), "first", "sightings")
        base = F.struct(*[F.col(f"first.insert.{name}").alias(name) for name in figures])
        keywords, stored = F.col("first.keywords"), F.lit(False)
    else:
        kept = tracking.select(*KEY, F.struct(*STATE, "post_id", "keywords").alias("stored"))
        joined = kept.alias("t").join(found.alias("f"), same_key("t", "f"), "full")
        both = joined.select(
            *[F.coalesce(F.col(f"t.{name}"), F.col(f"f.{name}")).alias(name) for name in KEY], "stored", "first", "sightings"
        )
        stored = F.col("stored").isNotNull()
        old = {"at": F.lit(None).cast("timestamp_ntz"), "seq": F.lit(0).cast("bigint")}
        old.update({name: F.col(f"stored.{name}") for name in (*STATE, "post_id")})
        base = F.struct(*[
            F.when(stored, old[name]).otherwise(F.col(f"first.insert.{name}")).alias(name) for name in figures
        ])
        keywords = F.when(stored, F.array_distinct("stored.keywords")).otherwise(F.col("first.keywords"))

    def earliest(s: Column) -> Column:
        sure = stored | (s["any"] >= F.col("first.insert"))
        return F.when(sure, s["any"]).otherwise(F.least(s["full"], s["late"]))

    def row(kind: int, s: Column, words: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), *[s[name].alias(name) for name in figures], F.to_json(words).alias("words")
        )

    new = F.filter(
        F.transform(F.coalesce("sightings", F.array()), lambda s: F.struct(s["keyword"].alias("keyword"), earliest(s).alias("own"))),
        lambda s: s["own"].isNotNull() & ~F.array_contains("_keywords", s["keyword"]),
    )
    rows = F.concat(
        F.array(row(BASE, F.col("_base"), F.col("_keywords"))),
        F.transform("_new", lambda s: row(FORCED, s["own"], F.array(s["keyword"]))),
    )
    return (
        both.withColumns({"_base": base, "_keywords": keywords})
        # Without a stored state or a hit that can insert, the URL stays unknown.
        .filter(F.col("_base.status").isNotNull())
        .withColumn("_new", new)
        .select(*KEY, F.inline(rows))
        .withColumn("blank", F.lit(False))
    )


STATE_TYPE = (
    "struct<view:int,comment_count:int,status:string,created_at:timestamp_ntz,checked_at:timestamp_ntz,"
    "blank_at:timestamp_ntz,blank_seq:bigint,fired:boolean>"
)


def combine(outcomes: Column, threshold: int, rule: str) -> Column:
    """Run one URL's state through the outcomes of its ranges, in order."""

    def fires(s: Column, o: Column) -> Column:
        view, count = s["view"].cast("bigint"), s["comment_count"].cast("bigint")
        lower = (o["view_low"] < view - threshold) | (o["count_low"] < count)
        if rule == "literal":
            return lower
        return lower | (o["view_high"] > view + threshold) | (o["count_high"] > count)

    def state(s: Column, t: Column, fired: Column) -> Column:
        taken = t.isNotNull()
        blank = s["blank_at"].isNull() & taken
        return F.struct(
            *[F.when(taken, t[name]).otherwise(s[name]).alias(name) for name in ("view", "comment_count", "status", "created_at", "checked_at")],
            *[F.when(blank, t[name]).otherwise(s[name]).alias(name) for name in ("blank_at", "blank_seq")],
            fired.alias("fired"),
        )

    def step(s: Column, o: Column) -> Column:
        fired = F.coalesce(s["fired"] & (o["n"] > 0), F.lit(False))
        free = s["status"].isNotNull() & ~fired
        reached = F.get(F.filter(o["entries"], lambda e: F.coalesce(fires(s, e), F.lit(False))), F.lit(0))
        sure = F.get(o["states"], F.lit(0))
        target = F.when(o["role"] == "known", sure).when(free & (o["role"] == "entry"), F.get(o["states"], reached["path"]))
        # one pass through ``transform``, so that the target is looked up once
        moved = F.get(
            F.transform(F.array(target), lambda t: state(s, t, fired | (t.isNotNull() & (o["role"] == "entry")))), F.lit(0))
        failed = s.withField("status", sure["status"]).withField("checked_at", sure["checked_at"]).withField("fired", fired)
        return F.when(free & (o["role"] == "unstable"), failed).otherwise(moved).cast(STATE_TYPE)

    return F.aggregate(outcomes, F.lit(None).cast(STATE_TYPE), step)


LONG = 64  # outcome rows of a URL that are combined in one row, at most


def final_state(outcomes: DataFrame, threshold: int, rule: str, long: int = LONG, most: int | None = None) -> DataFrame:
    """One row per URL from the outcomes of its ranges and the keywords it met.

    The outcomes of a URL follow each other in the order of their partitions. A URL with up to
    ``long`` outcome rows is combined in one row; the rows of others are sorted and walked
    through with one state kept, so that no row grows with a URL's hits. What is collected
    per URL in any case is its keywords. ``most``: outcome rows that no URL can exceed.
    """
    names = ["part", "n", "role", "entries", "states", "at", "seq", "post_id", "words"]
    many = walked = None
    if most is None or most > long:
        outcomes = materialize(outcomes, "outcomes")
        many = outcomes.filter("role <> 'words'").groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > long).select(*KEY)
    if many is not None and not many.isEmpty():
        many = materialize(many, "long-urls")
        chained = outcomes.alias("o").join(many.alias("m"), same_key("o", "m"), "left_semi")
        walked = chained.filter("role <> 'words'").repartition(*KEY).sortWithinPartitions(*KEY, "part", "n").mapInPandas(
            chain_outcomes(threshold, rule == "documented"), FINAL_SCHEMA)
        noted = with_notes(chained.filter("role = 'words'"))
        state = F.struct(*[F.col(f"w.{name}").alias(name) for name in CHAIN])
        walked = walked.alias("w").join(noted.alias("n"), same_key("w", "n"), "left").select(
            "w.platform", "w.url", state.alias("final"), F.coalesce("n.notes", F.array().cast(NOTES)).alias("notes"), F.col("n.post_id").alias("post_id"))
        outcomes = outcomes.alias("o").join(many.alias("m"), same_key("o", "m"), "left_anti")
    packed = outcomes.withColumn("entries", F.arrays_zip(*INTERVALS))
    rows = packed.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct(*names))).alias("rows"))
    steps = F.filter("rows", lambda o: o["role"] != "words")
    notes = F.transform(
        F.filter("rows", lambda o: o["role"] == "words"),
        lambda o: F.struct(o["at"].alias("at"), o["seq"].alias("seq"), o["words"].alias("words")),
    )
    states = rows.select(
        *KEY, combine(steps, threshold, rule).alias("final"), notes.alias("notes"),
        F.array_max(F.transform("rows", lambda o: o["post_id"])).alias("post_id"))
    if walked is not None:
        plain = F.struct(*[F.col(f"final.{name}").alias(name) for name in CHAIN])
        states = states.withColumn("final", plain).unionByName(walked)
    final = F.col("final")
    blank = F.when(
        final["blank_at"].isNotNull(),
        F.array(F.struct(final["blank_at"].alias("at"), final["blank_seq"].alias("seq"), F.lit('[""]').alias("words"))),
    ).otherwise(F.filter("notes", lambda _: F.lit(False)))
    met = F.transform(F.array_sort(F.concat("notes", blank)), lambda n: F.from_json(n["words"], "array<string>"))
    return (
        states.select(*KEY, F.array_distinct(F.flatten(met)).alias("keywords"), "post_id", *[final[name].alias(name) for name in STATE])
        # Hits of URLs that never became known leave outcomes, but no state.
        .filter(F.col("status").isNotNull())
        .select(*TRACKING_SCHEMA.names)
    )


NOTES = "array<struct<at:timestamp_ntz,seq:bigint,words:string>>"


def with_notes(words: DataFrame) -> DataFrame:
    return words.groupBy(*KEY).agg(F.collect_list(F.struct("at", "seq", "words")).alias("notes"), F.max("post_id").alias("post_id"))


def status_transition(tracking: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply status ``changes`` (platform, url, status, checked_at, seq) in seq order.

    The last status wins; a change without checked_at leaves the time as it was.
    """
    timed = F.col("checked_at").isNotNull()
    last = changes.groupBy(*KEY).agg(
        F.max_by("status", "seq").alias("_status"),
        F.max_by("checked_at", F.when(timed, F.col("seq"))).alias("_checked_at"),
    )
    return (
        tracking.join(last, KEY, "left")
        .withColumns({"status": F.coalesce("_status", "status"), "checked_at": F.coalesce("_checked_at", "checked_at")})
        .select(*tracking.columns)
    )


def detail_refresh(tracking: DataFrame, details: DataFrame) -> DataFrame:
    """Store the figures of read detail pages (…, seq) and mark their URLs UNCHANGED.

    The last detail of a URL wins; one with a missing figure changes nothing.
    """
    names = ["comment_count", "view", "created_at"]
    whole = details.dropna(subset=names)
    last = whole.groupBy(*KEY).agg(F.max_by(F.struct(*names), "seq").alias("_detail"))
    updates = {
        name: F.coalesce(F.col(f"_detail.{name}").cast(tracking.schema[name].dataType), F.col(name)) for name in names
    }
    updates["status"] = F.when(F.col("_detail").isNotNull(), "UNCHANGED").otherwise(F.col("status"))
    return tracking.join(last, KEY, "left").withColumns(updates).select(*tracking.columns)


def failed_write_rollback(tracking: DataFrame, urls: DataFrame, status: str) -> DataFrame:
    """Put the URLs of a landing that failed back to ``status``."""
    failed = urls.select(*KEY).distinct().withColumn("_failed", F.lit(True))
    return (
        tracking.join(failed, KEY, "left")
        .withColumn("status", F.when(F.col("_failed"), F.lit(status)).otherwise(F.col("status")))
        .select(*tracking.columns)
    )


def claim_pending(tracking: DataFrame, now: Column, limit: int | None = None, reclaim_failed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Take URLs to crawl, oldest check first: (claimed rows, tracking afterwards).

    Taken are CHANGED rows and BANNED ones checked more than an hour ago. They are
    returned as CHANGED and stored as UNCHANGED.
    """
    status = F.col("status")
    ready = (status == "CHANGED") | ((status == "BANNED") & (now - F.col("checked_at") > F.expr("INTERVAL 1 HOUR")))
    if reclaim_failed:
        ready = ready | (status == "FAILED")
    taken = tracking.filter(ready)
    if limit is None:
        after = tracking.withColumn("status", F.when(ready, "UNCHANGED").otherwise(status))
    else:
        taken = first_rows(taken, ["checked_at", *KEY], limit)
        after = failed_write_rollback(tracking, taken, "UNCHANGED")
    return taken.withColumn("status", F.lit("CHANGED")), after


def first_rows(df: DataFrame, order: list[str], limit: int) -> DataFrame:
    """The ``limit`` first rows by ``order``, which tells rows apart; no task holds them all.

    Rows are written in ordered ranges. Counts say which ranges are taken whole; only the
    rows of ranges that begin before the limit are numbered.
    """
    dealt = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        dealt.join(before.filter(F.col("_before") < limit), "_part")
        .withColumn("_inside", inside)
        .filter(F.col("_before") + F.col("_inside") <= limit)
        .select(*df.columns)
    )
