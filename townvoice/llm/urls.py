"""URL filters (operator 9): rules, and boosted trees for the URLs no rule covers.

DataFrame and ``pyspark.ml`` functions only. The URLs that a rule covers are the labelled
ones. Lexical features (length, depth, digit ratio, entropy, parameters, and statistics of
the host's suffixes) feed gradient-boosted trees; the trees judge the rest. What a suffix says
of a labelled URL comes from the labels of other folds, so none is learned from its own label.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, materialize, table


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
)
FEATURES = ["length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "parameters", "hyphens",
            "fragment", "secure", "top_blocked", "top_share", "domain_blocked", "domain_share"]
TRAIN_ROWS = 50_000  # labelled URLs that the trees are fitted on, at most: those of least hash
PRIOR = 20.0  # labelled URLs that a suffix counts as having besides its own
FOLDS = 5  # a labelled URL sees the labels of the other folds; equal URLs are in one


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and where there is no ``://``."""
    rest = F.when(url.contains("://"), F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), upper, upper.lower()),
            F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1))


def matched(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as ``host/path``, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.host + rule.path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for the empty text."""
    def of(characters):
        n = F.size(characters)
        shares = F.transform(F.array_distinct(characters), lambda c: (n - F.size(F.array_remove(characters, c))) / n)
        return -F.aggregate(shares, F.lit(0.0), lambda total, p: total + p * F.log2(p))
    return F.when(F.length(text) > 0, let(F.split(text, ""), of)).otherwise(F.lit(0.0))


def lexical(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``pages`` with host, path, rule, label and the features that need no other row."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = parts(F.col("url"))
    placed = pages.withColumns({"host": host, "path": path})
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    count = lambda pattern: F.size(F.split(url, pattern)) - 1
    numbers = {
        "length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": F.size(F.split("path", "/")) - 1, "labels": F.size(F.split("host", r"\.")),
        "digits": (F.length(url) - F.length(F.translate(url, "0123456789", ""))) / F.greatest(F.lit(1), F.length(url)),
        "entropy": entropy(url), "parameters": F.when(url.contains("?"), count("&") + 1).otherwise(0),
        "hyphens": count("-"), "fragment": url.contains("#"), "secure": url.startswith("https:"),
    }
    return placed.withColumns({"rule": rule, "label": (verdict == "block").cast("double")}).withColumns(
        {k: v.cast("double") for k, v in numbers.items()}).withColumns({
            "top": F.substring_index("host", ".", -1), "domain": F.substring_index("host", ".", -2)})


def with_suffixes(rows: DataFrame) -> DataFrame:
    """Adds what the labelled and all URLs say of a host's last label and last two labels.

    A labelled URL gets the share of blocked ones among the labelled URLs of the other folds,
    any other that among all labelled URLs.
    """
    rows = rows.withColumn("fold", F.pmod(F.xxhash64(F.lit(5), F.coalesce("url", F.lit(""))), F.lit(FOLDS)).cast("int"))
    seen = (F.count(F.lit(1)).alias("n"), F.count("label").alias("known"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("bad"))
    folds = {row.fold: row for row in rows.groupBy("fold").agg(*seen).collect()}
    total, known, bad = (sum(row[c] for row in folds.values()) for c in ("n", "known", "bad"))

    def mean(other_known: int, other_bad: float) -> Column:
        return F.lit(other_bad / max(1, other_known))

    means = F.array(*(mean(known - folds[i].known, bad - folds[i].bad) if i in folds else F.lit(0.0) for i in range(FOLDS)))
    labelled = F.col("label").isNotNull()
    prior = F.when(labelled, F.get(means, F.col("fold"))).otherwise(mean(known, bad))
    for suffix in ("top", "domain"):
        counts = rows.groupBy(suffix, "fold").agg(*seen).groupBy(suffix).agg(
            F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("bad").alias("bad"),
            F.map_from_entries(F.collect_list(F.struct("fold", F.struct("known", "bad")))).alias("of"))
        own = F.when(labelled, F.col("of")[F.col("fold")])
        others = {c: F.col(c) - F.coalesce(own[c], F.lit(0)) for c in ("known", "bad")}
        rows = rows.join(counts, suffix).withColumns({
            f"{suffix}_share": F.log10(F.col("n") / max(1, total)),
            f"{suffix}_blocked": (others["bad"] + PRIOR * prior) / (others["known"] + PRIOR),
        }).drop("n", "known", "bad", "of")
    return rows


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``, a row for each page.

    A rule decides where one fits (score null); elsewhere a score of 0.5 or more blocks. The
    trees learn from the ``train_rows`` labelled URLs of least hash. If the labels are all
    alike or missing, there is nothing to learn: the others take that verdict, allow without
    labels. Null, empty and malformed URLs are judged by the trees like any other; repeated
    rows are judged alike; other columns are ignored; no rows give no rows.
    """
    rows = materialize(with_suffixes(materialize(lexical(pages.select("page_id", "url"), rules), "urls")), "features")
    picked = rows.filter("label is not null").orderBy(F.xxhash64("url"), "url").limit(train_rows)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    sample = materialize(vectors.transform(picked).select("label", "features"), "sample")
    kinds = [row.label for row in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        scored = rows.withColumn("score", F.lit(kinds[0] if kinds else 0.0))
    else:
        trees = GBTClassifier(maxIter=15, maxDepth=4, maxBins=32, seed=9, stepSize=0.3).fit(sample)
        scored = trees.transform(vectors.transform(rows)).withColumn("score", vector_to_array("probability")[1])
    block = F.when(F.col("label").isNotNull(), F.col("label") == 1.0).otherwise(F.col("score") >= 0.5)
    return scored.select("page_id", "host", "path", "rule", F.when(block, "block").otherwise("allow").alias("verdict"),
                         F.when(F.col("label").isNull(), F.col("score")).alias("score"))


def op9_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
