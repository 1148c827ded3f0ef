"""Mixing sources to target weights by entropy balancing (operator 6), DataFrame functions only.

Document rates ``r`` minimise the relative entropy of the mix to the corpus, a document each,
under one token constraint a source: the sum of ``size * r`` is the source's target; no rate
passes the limit. The convex dual has one multiplier ``x`` a source and tilts its documents
exponentially: ``r = min(limit, exp(x * size))``. Newton steps, kept between bounds, solve it
for all sources at once: each takes value and slope of the dual from one aggregation over
counts by source and size. A multiplier above 0 favours long documents, one below short ones.

Rates become whole copies size by size, the longest first; what rounding leaves over or short
is carried to the next size, so that a source ends near its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_hash, materialize, table, words

WEIGHTS = (5, 2, 1)  # of the sources in code point order, repeating
LIMIT = 3  # times a source's size, and copies of a document, at most
STEPS = 80  # at most; a dozen are usual
CLOSE = 1e-9  # of a target: how near the sum of the rates comes to it
PIECE = 4096  # documents of one source and size that are ranked together, about
SIZES = 512  # sizes of a source that are rounded in one row, about


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``source, source_size`` -> the same and ``target``: shares by weight, stopped at the limit.

    What sources at their limit leave goes to the others by weight, until none is above:
    each target is the smaller of its limit and weight times one level. The level follows
    from the sources in order of limit by weight. One row a source; null is a source, the last.
    """
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = sources.withColumn("__w", F.element_at(F.array(*map(F.lit, weights)), (order % len(weights) + 1).cast("int")).cast("double"))
    ratio = F.col("source_size") * limit / F.col("__w")
    before = Window.orderBy("__ratio", F.col("source").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    level = (
        (F.sum("source_size").over(everything) - limit * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        / (F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0.0)))
    )
    found = weighted.withColumn("__ratio", ratio).withColumn("__level", level)
    # the first source, in this order, that stays below its limit sets the level
    below = F.min(F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", "__level"))).over(everything)
    target = F.least((F.col("source_size") * limit).cast("double"), F.col("__w") * below["__level"])
    return found.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def rate_of(multiplier: Column, size: Column, limit: int = LIMIT) -> Column:
    """The rate of documents of ``size``; a null multiplier is one without bound below, and all rates are 0."""
    return F.when(multiplier.isNull(), F.lit(0.0)).otherwise(F.least(F.lit(float(limit)), F.exp(F.least(F.lit(700.0), multiplier * size))))


def multipliers(groups: DataFrame, goals: DataFrame, limit: int = LIMIT, steps: int = STEPS) -> DataFrame:
    """``goals`` (``source, source_size, target``) with ``multiplier`` and ``residual``, of the target.

    ``groups`` are ``source, size, n`` with sizes above 0. From 0 on: Newton's step where it
    stays between the bounds that earlier values set, else their middle. Every step is one
    aggregation whose partial rows are one a task and source; the state is a row a source.
    """
    least = groups.groupBy("source").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    same = F.col("g.source").eqNullSafe(F.col("s.source"))
    # at ``high`` every rate is at the limit; ``low`` cannot be passed, as each rate is below target / source_size
    high = F.log(F.lit(float(limit))) / F.col("least") + 1e-9
    low = F.log(F.col("target") / (F.col("source_size") * F.lit(1e6))) / F.col("least")
    full = F.col("target") >= F.col("source_size") * limit * (1 - 1e-12)
    first = F.when(full & (F.col("target") > 0), high).when(F.col("target") > 0, F.lit(0.0))
    state = materialize(
        goals.alias("s").join(least.alias("g"), same, "left")
        .select("s.source", "source_size", "target", first.alias("multiplier"),
                F.when(F.col("target") < F.col("source_size"), low).otherwise(0.0).alias("low"),
                F.when(F.col("target") > F.col("source_size"), high).otherwise(0.0).alias("high"), F.lit(1.0).alias("residual")), "dual")
    for _ in range(steps):
        rate = rate_of(F.col("multiplier"), F.col("size"), limit)
        slope = F.when(rate < limit, F.col("n") * F.col("size") * F.col("size") * rate).otherwise(0.0)
        sums = groups.alias("g").join(state.alias("s"), same).groupBy("g.source").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("value"), F.sum(slope).alias("slope"))
        over = F.col("value") - F.col("target")
        at = F.col("multiplier")
        lower, upper = F.when(over < 0, at).otherwise(F.col("low")), F.when(over > 0, at).otherwise(F.col("high"))
        newton = at - over / F.col("slope")
        step = F.when((F.col("slope") > 0) & (newton > lower) & (newton < upper), newton).otherwise((lower + upper) / 2)
        residual = F.when(F.col("target") > 0, F.abs(over) / F.col("target")).otherwise(0.0)
        done = residual <= CLOSE
        state = materialize(
            state.alias("s").join(sums.alias("g"), same, "left").select(
                "s.source", "source_size", "target", F.when(at.isNull() | done, at).otherwise(step).alias("multiplier"),
                lower.alias("low"), upper.alias("high"), F.coalesce(residual, F.lit(0.0)).alias("residual")), "dual")
        if (state.agg(F.max("residual")).first()[0] or 0.0) <= CLOSE:
            break
    return state.drop("low", "high")


def copies_by_size(groups: DataFrame, dual: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``source, size, n`` with ``copies`` that all n documents get together; each one's rate is rounded down or up.

    A source's sizes are dealt over rows of about ``SIZES``, long and short ones in each, so
    that neither a row nor the work in one grows with them; each row carries its rounding down
    to its shortest documents.
    """
    empty = F.array().cast("array<bigint>")

    def merge(state, group):
        want = group["rate"] * group["n"] * group["size"] + state["carry"]
        most, least = F.ceil(group["rate"]) * group["n"], F.floor(group["rate"]) * group["n"]
        take = F.least(most, F.greatest(least, F.round(want / group["size"]).cast("long")))
        return F.struct((want - take * group["size"]).alias("carry"), F.concat(state["taken"], F.array(take)).alias("taken"))

    same = F.col("g.source").eqNullSafe(F.col("s.source"))
    numbered = groups.withColumns({
        "place": F.row_number().over(Window.partitionBy("source").orderBy(F.col("size").desc())),
        "rows": F.ceil(F.count(F.lit(1)).over(Window.partitionBy("source")) / SIZES)})
    rated = numbered.alias("g").join(dual.alias("s"), same).select(
        "g.source", "size", "n", (F.col("place") % F.col("rows")).alias("row"), rate_of(F.col("multiplier"), F.col("size"), limit).alias("rate"))
    sizes = rated.groupBy("source", "row").agg(F.sort_array(F.collect_list(F.struct("size", "n", "rate")), asc=False).alias("sizes"))
    start = F.struct(F.lit(0.0).alias("carry"), empty.alias("taken"))
    return (
        sizes.withColumn("taken", F.aggregate("sizes", start, merge)["taken"])
        .select("source", F.inline(F.arrays_zip("sizes", "taken")))
        .select("source", "sizes.size", "sizes.n", F.col("taken").alias("copies"))
    )


def balance(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``size, source_size, target, rate`` and ``copies`` added.

    Null texts and texts without a word have size 0 and no copies; a null source is a source.
    Of rows that agree in every column the first get the copies that are over; such rows are
    the same, so the result is the same for any order and layout of the input. Columns of
    these names are replaced; no rows give no rows. No group of documents is gathered: ranks
    come from counts by source, size and hash piece, and a numbering inside pieces of bounded size.
    """
    plain = docs.drop("size", "source_size", "target", "rate", "copies")
    every = [F.xxhash64(c) for c in plain.columns] + [F.col(c).isNull() for c in plain.columns]
    sized = plain.withColumns({"size": F.size(words(F.col("text"))).cast("long"), "__row": F.xxhash64(*every)})
    ids = materialize(sized.groupBy("source", "size", "doc_id", "__row").agg(F.count(F.lit(1)).alias("k")), "sizes")
    groups = materialize(ids.groupBy("source", "size").agg(F.sum("k").alias("n")), "groups")
    some = groups.filter("size > 0")
    sources = materialize(groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), "sources")
    dual = multipliers(some, materialize(targets(sources, weights, limit), "targets"), limit)
    shares = materialize(_shares(ids, copies_by_size(some, dual, limit)), "shares")
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("__row", "doc_id", "source", "size")]
    joined = sized.alias("b").join(shares.alias("s"), same, "left").select("b.*", "k", "least", "more")
    single = joined.filter("k is null or k = 1").withColumn("__copies", F.col("least") + F.col("more"))
    if not ids.filter("k > 1 and size > 0").isEmpty():  # of rows that are the same, one stands for all
        equal = joined.filter("k > 1").dropDuplicates(["__row", "doc_id", "source", "size"])
        numbered = equal.withColumn("__place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
        single = single.unionByName(numbered.withColumn("__copies", F.col("least") + (F.col("__place") < F.col("more")).cast("long")).drop("__place"))
    return (
        single.alias("b").join(dual.alias("r"), F.col("b.source").eqNullSafe(F.col("r.source")))
        .select(*[F.col(f"b.{c}") for c in plain.columns], "b.size", "r.source_size", "r.target",
                rate_of(F.col("multiplier"), F.col("b.size"), limit).alias("rate"), F.coalesce("__copies", F.lit(0)).cast("long").alias("copies"))
    )


def _shares(ids: DataFrame, by_size: DataFrame) -> DataFrame:
    """``least`` copies for each row, and ``more`` for the ``k`` rows together that are the same.

    Within a source and size rows follow each other by hash; the first get the copies that are
    over after all got the same number.
    """
    dealt = by_size.select("source", "size", "n", F.floor(F.col("copies") / F.col("n")).alias("least"),
                           (F.col("copies") % F.col("n")).alias("over"), F.ceil(F.col("n") / PIECE).alias("pieces"))
    piece = F.floor(F.shiftrightunsigned(F.col("hash"), 33) * F.col("pieces") / F.lit(float(1 << 31)))
    same = F.col("i.source").eqNullSafe(F.col("d.source")) & (F.col("i.size") == F.col("d.size"))
    placed = (
        ids.alias("i").join(dealt.alias("d"), same)
        .select("i.doc_id", "i.__row", "i.source", "i.size", "k", "n", "least", "over", "pieces", F.xxhash64(id_hash("i.doc_id"), "i.__row").alias("hash"))
        .withColumn("piece", piece)
    )
    keys = ["source", "size", "piece"]
    earlier = Window.partitionBy("source", "size").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy(*keys).agg(F.sum("k").alias("rows")).select(
        *keys, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    same = F.col("p.source").eqNullSafe(F.col("f.source")) & (F.col("p.size") == F.col("f.size")) & (F.col("p.piece") == F.col("f.piece"))
    inside = Window.partitionBy("p.source", "p.size", "p.piece").orderBy("hash", "doc_id", "__row").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("before") + F.coalesce(F.sum("k").over(inside), F.lit(0))
    return placed.alias("p").join(before.alias("f"), same).select(
        "doc_id", "__row", "p.source", "p.size", "k", "least",
        F.least(F.col("k"), F.greatest(F.lit(0), F.col("over") - first)).alias("more"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it has copies."""
    copied = balance(docs, weights, limit).filter("copies > 0")
    repeated = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")
    return copied.select("*", repeated).select(docs.columns)


def op6_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
