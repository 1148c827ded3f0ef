"""Batch summaries: volume, views, sentiment counts and term mentions.

A mention is the presence of a term in a row, case-sensitive, not its number of
occurrences. All figures come from one aggregation over one scan: each task keeps
one partial row per batch, so neither the number of rows nor a hot batch matters to
the shuffle.

Every operator takes rows with their content, or rows that already went through
:func:`keyword_flags`. Flag first and drop the content when something has to be joined
to the rows before summing: then the texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lexicon import DEFAULT_LEXICON, Lexicon, of_category
from ..schemas import POSTS_SCHEMA, SENTIMENTS


def project_posts(df: DataFrame) -> DataFrame:
    """The 13 analytic columns in their contract order."""
    return df.select(*POSTS_SCHEMA.names)


def align_columns(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both inputs with the union of their columns, sorted by name, gaps as NULL."""
    types = {f.name: f.dataType for f in [*right.schema.fields, *left.schema.fields]}

    def widen(df: DataFrame) -> DataFrame:
        return df.select(*[
            F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(types[name]).alias(name)
            for name in sorted(types)
        ])

    return widen(left), widen(right)


def union_posts_comments(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """All posts and comments as rows of one table; comments lack the post columns."""
    return posts.unionByName(comments, allowMissingColumns=True)


def mentions(term: str, content: str = "content") -> Column:
    return F.when(F.col(content).contains(term), 1).otherwise(0)


def keyword_flags(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON, content: str = "content") -> DataFrame:
    """``<name>_count`` per term: 1 where the content contains it, else 0."""
    return df.select("*", *[mentions(term, content).alias(f"{name}_count") for _, term, name in lexicon])


BITS = 63  # flags in one bigint


def packed_flags(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON, content: str = "content") -> DataFrame:
    """All flags of a row as the bits of ``_bits0``, ``_bits1``, ...: what a join has to move of a text."""
    words = []
    for start in range(0, len(lexicon), BITS):
        bits = [F.when(F.col(content).contains(term), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
                for i, (_, term, _) in enumerate(lexicon[start : start + BITS])]
        words.append(reduce(lambda a, b: a.bitwiseOR(b), bits).alias(f"_bits{start // BITS}"))
    return df.select("*", *words)


def unpacked_flags(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """The columns of :func:`keyword_flags` from packed ones, for the same lexicon."""
    packed = [name for name in df.columns if name.startswith("_bits")]
    flags = [
        F.shiftright(f"_bits{i // BITS}", i % BITS).bitwiseAND(F.lit(1)).cast("int").alias(f"{name}_count")
        for i, (_, _, name) in enumerate(lexicon)
    ]
    return df.select(*[name for name in df.columns if name not in packed], *flags)


def flag(df: DataFrame, term: str, name: str) -> Column:
    """The term's flag: its column where the rows have it, else worked out here."""
    column = f"{name}_count"
    return F.col(column) if column in df.columns else mentions(term)


def sentiment_metrics() -> list[Column]:
    return [
        F.sum("view").alias("total_views"),
        F.count(F.lit(1)).alias("total_posts_comments"),
        *[F.sum((F.col("sentiment") == label).cast("int")).alias(label) for label in SENTIMENTS],
    ]


def mention_totals(df: DataFrame, lexicon: Lexicon) -> list[Column]:
    return [F.sum(flag(df, term, name)).alias(f"{name}_total_count") for _, term, name in lexicon]


def sentiment_summary(df: DataFrame) -> DataFrame:
    """Views, rows and rows per label. Unlabelled rows count as rows only."""
    return df.agg(*sentiment_metrics())


def category_totals(df: DataFrame, category: str, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    return df.agg(*mention_totals(df, of_category(lexicon, category)))


def accident_totals(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    return category_totals(df, "accident", lexicon)


def brand_totals(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    return category_totals(df, "brand", lexicon)


def model_totals(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    return category_totals(df, "model", lexicon)


def ev_issue_totals(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    return category_totals(df, "ev_issue", lexicon)


def stamp_checked_at(summary: DataFrame, checked_at: str) -> DataFrame:
    """Put the batch time in front of a one-row summary."""
    return summary.select(F.lit(checked_at).cast("timestamp_ntz").alias("checked_at"), "*")


def batch_summary(df: DataFrame, checked_at: str, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """The whole summary of one batch in one row. An empty batch still gives a row."""
    return stamp_checked_at(df.agg(*sentiment_metrics(), *mention_totals(df, lexicon)), checked_at)


def summary_history(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """One summary row per batch time found in the data."""
    return df.groupBy("checked_at").agg(*sentiment_metrics(), *mention_totals(df, lexicon))


MANY_TERMS = 200  # beyond, terms are found by an automaton instead of a column expression each


def keyword_long(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """Totals as rows (category, name, total); terms never mentioned have total 0.

    The way terms are found depends on their number, the totals do not.
    """
    if len(lexicon) > MANY_TERMS:
        return keyword_long_by_automaton(df, lexicon)
    totals = df.agg(*[F.coalesce(F.sum(flag(df, term, name)), F.lit(0).cast("bigint")).alias(name) for _, term, name in lexicon])
    entries = F.array(*[
        F.struct(F.lit(category).alias("category"), F.lit(name).alias("name"), F.col(name).alias("total"))
        for category, _, name in lexicon
    ])
    return totals.select(F.inline(entries))


def term_counts(df: DataFrame, terms: list[str], content: str = "content") -> DataFrame:
    """``term_id, total``: rows whose content holds each term, terms of no row left out.

    One walk over a text finds all terms, overlapping ones too, so time does not grow with
    their number. A task sends a row for each term it met.
    """
    shared = df.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = ahocorasick.Automaton()
        for number, term in enumerate(shared.value):
            if term:
                tree.add_word(term, number)
        found = [0] * len(shared.value)
        every = [number for number, term in enumerate(shared.value) if not term]  # the empty term is in every text
        if len(tree):
            tree.make_automaton()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text is not None:
                    for number in {number for _, number in tree.iter(text)} if len(tree) else ():
                        found[number] += 1
                    for number in every:
                        found[number] += 1
        met = [number for number, n in enumerate(found) if n]
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array([found[n] for n in met], pa.int64())], ["term_id", "total"])

    parts = df.select(F.col(content).cast("string")).mapInArrow(count, "term_id int, total bigint")
    return parts.groupBy("term_id").agg(F.sum("total").alias("total"))


def keyword_long_by_automaton(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    """:func:`keyword_long` for lexicons of many thousands of terms, from rows with their content."""
    number = {term: i for i, term in enumerate(dict.fromkeys(term for _, term, _ in lexicon))}
    rows = [(category, name, number[term]) for category, term, name in lexicon]
    named = df.sparkSession.createDataFrame(rows, "category string, name string, term_id int")
    found = named.join(term_counts(df, list(number)), "term_id", "left")
    return found.select("category", "name", F.coalesce("total", F.lit(0).cast("bigint")).alias("total"))


def sentiment_summary_v1(posts: DataFrame, comments: DataFrame, checked_at: str) -> DataFrame:
    """The five base figures as INT from separate inputs; views come from posts alone.

    Unlike :func:`sentiment_summary` labels are counted, so an empty batch gives 0.
    """
    tagged = posts.select(F.col("view"), "sentiment").unionByName(
        comments.select(F.lit(None).cast("bigint").alias("view"), "sentiment")
    )
    figures = tagged.agg(
        F.sum("view").cast("int").alias("total_views"),
        F.count(F.lit(1)).cast("int").alias("total_posts_comments"),
        *[F.count_if(F.col("sentiment") == label).cast("int").alias(label) for label in SENTIMENTS],
    )
    return stamp_checked_at(figures, checked_at)


def dedupe(df: DataFrame, *keys: str) -> DataFrame:
    """One row per post and batch, for sources that collect a post repeatedly.

    Of a post's rows the one with the greatest figures stays: view, then comment count,
    like, dislike and the other columns by name. Rows without a platform or post id are no
    posts (comments, in merged rows) and stay as they are.
    """
    keys = keys or ("platform", "post_id", "checked_at")
    is_post = F.col("platform").isNotNull() & F.col("post_id").isNotNull()
    figures = [name for name in ("view", "comment_count", "like", "dislike") if name in df.columns]
    order = F.struct(*figures, *sorted(set(df.columns) - set(figures)))
    best = df.filter(is_post).groupBy(*keys).agg(F.max_by(F.struct(*df.columns), order).alias("row")).select("row.*")
    return best.unionByName(df.filter(~is_post))
