"""Quality rules by distribution divergence (operator 5), DataFrame functions only.

A document's histograms of character classes and of common words are compared with those of
its language by Jensen-Shannon distance (base 2, so 0 to 1). The references are measured
over all documents of a language. Short documents are not judged by histograms that their
length cannot fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_BREAK, let, materialize, table, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent
# character classes, in order; what is in none is the last class
CLASSES = (r"\p{Lu}", r"\p{Ll}", r"\p{N}", r"[\s]", r"[.,;:!?]", r"[#*$%&|<>]")
# frequent function words of the languages that have a word histogram; fixed values
COMMON = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch"),
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "this", "are", "or", "from"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "a", "par", "au", "sur", "la"),
}
GUARD_CHARS = 200  # characters below which classes are not judged
GUARD_WORDS = 50  # words below which common words are not judged
MOST_CLASS = 0.34  # Jensen-Shannon distance of classes that is still kept
MOST_WORDS = 0.5  # and of common words


def repeated_words(tokens: Column) -> Column:
    """Words inside windows of 8 words that the text holds twice or more, first included.

    Windows are compared by 64-bit hashes of their words' hashes. Where all differ, which a
    hash set tells, that is all; else windows are sorted by hash, and the places of equal
    neighbours give the covered words: 8 from each place, less where the next is nearer.
    """
    def of_windows(windows):
        def of_sorted(ordered):
            same = lambda i: F.get(ordered, i)["h"] == F.get(ordered, i + 1)["h"]
            twins = F.filter(ordered, lambda w, i: F.coalesce(same(i), F.lit(False)) | F.coalesce(F.when(i > 0, same(i - 1)), F.lit(False)))
            def covered(places):
                return F.aggregate(
                    F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)))),
                    F.lit(0), lambda total, n: total + n)
            return let(F.array_sort(F.transform(twins, lambda w: w["at"])), covered)
        structs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(F.array_sort(structs), of_sorted))

    def of_words(hashes):
        n = F.size(hashes) - (WINDOW - 1)
        return let(F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW))), of_windows)

    hashed = F.transform(tokens, lambda w: F.xxhash64(w))
    return F.when(F.size(tokens) > WINDOW, let(hashed, of_words)).otherwise(F.lit(0)).cast("long")


def class_counts(text: Column) -> Column:
    """Characters of each class, as an array; the counts add up to the length."""
    counts = [F.length(text) - F.length(F.regexp_replace(text, pattern, "")) for pattern in CLASSES]
    rest = F.length(text) - sum(counts[1:], counts[0])
    return F.array(*[c.cast("double") for c in counts], rest.cast("double"))


def word_counts(tokens: Column, lang: Column) -> Column:
    """How often each common word of the language occurs, then all other words; null without one."""
    lists = F.create_map(*[part for key, value in COMMON.items() for part in (F.lit(key), F.array(*map(F.lit, sorted(set(value)))))])
    every = sorted({word for value in COMMON.values() for word in value})

    def of(common, wanted):
        seen = F.transform(wanted, lambda w: (F.size(common) - F.size(F.array_remove(common, w))).cast("double"))
        return let(seen, lambda s: F.concat(s, F.array(F.size(tokens) - F.aggregate(s, F.lit(0.0), lambda t, x: t + x))))

    low = F.filter(F.transform(tokens, lambda w: F.regexp_replace(F.lower(w), r"[.,;:!?]+$", "")), lambda w: w.isin(every))
    return let(lists[F.coalesce(lang, F.lit(""))], lambda wanted: let(low, lambda common: F.when(wanted.isNotNull(), of(common, wanted))))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms given as counts or shares; null if one is empty."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def of(shares):
        def term(x):
            a, b = x["p"], x["q"]
            m = (a + b) / 2
            half = lambda v: F.when(v > 0, v * F.log2(v / m)).otherwise(F.lit(0.0))
            return (half(a) + half(b)) / 2
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(shares, F.lit(0.0), lambda s, x: s + term(x))))

    scaled = lambda a: F.when(total(a) > 0, let(total(a), lambda t: F.transform(a, lambda x: x / t)))
    return let(scaled(p), lambda a: let(scaled(q), lambda b: F.when(
        a.isNotNull() & b.isNotNull(), of(F.zip_with(a, b, lambda x, y: F.struct(x.alias("p"), y.alias("q")))))))


def measures(docs: DataFrame) -> DataFrame:
    """The counts of every document: a row each, without its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tokens = words(F.col("text"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    cut = docs.select("doc_id", "lang", text.alias("text"), tokens.alias("tokens"))
    return cut.select(
        "doc_id", "lang", F.size("tokens").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", WORD_BREAK, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        let(F.col("tokens"), repeated_words).alias("n_repeat_words"),
        F.length("text").cast("long").alias("n_chars"), class_counts(F.col("text")).alias("classes"),
        let(F.col("tokens"), lambda t: word_counts(t, F.col("lang"))).alias("common"),
    )


def summed(column: str, size: int) -> Column:
    return F.array(*[F.sum(F.get(F.col(column), F.lit(i))) for i in range(size)])


def judge(docs: DataFrame) -> DataFrame:
    """The counts, ``class_distance``, ``word_distance``, ``base_failed`` and ``kept``.

    ``kept`` is false if the base rules fail, or a distance that the document is long enough
    for is above its threshold. A null or unlisted language has a class reference like any
    other (null is one language), and no word histogram. Null and empty texts have no words
    and fail the base. Repeated rows are judged alike; other columns are ignored; no rows
    give no rows.
    """
    rows = materialize(measures(docs), "measures")
    width = max(len(set(value)) for value in COMMON.values()) + 1
    references = rows.groupBy("lang").agg(
        summed("classes", len(CLASSES) + 1).alias("class_reference"), summed("common", width).alias("word_reference"))
    # a language's list may be shorter than the longest
    references = references.withColumn("word_reference", F.filter("word_reference", lambda x: x.isNotNull()))
    joined = rows.alias("d").join(references.alias("r"), F.col("d.lang").eqNullSafe(F.col("r.lang"))).select(
        "d.*", "class_reference", "word_reference")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    by_class = F.when(F.col("n_chars") >= GUARD_CHARS, distance(F.col("classes"), F.col("class_reference")))
    by_word = F.when(F.col("n_words") >= GUARD_WORDS, distance(F.col("common"), F.col("word_reference")))
    judged = joined.withColumns({"base_failed": failed, "class_distance": by_class, "word_distance": by_word})
    alien = F.coalesce(F.col("class_distance") > MOST_CLASS, F.lit(False)) | F.coalesce(F.col("word_distance") > MOST_WORDS, F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~alien).drop("class_reference", "word_reference", "classes", "common")


def op5_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "class_distance", "word_distance")
