"""Operator 12 against scores worked out one by one."""

from __future__ import annotations

import math
import re

import pytest

from townvoice.llm import lexical

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return PATTERN.findall(lower)


def plain(docs, items, keep=50):
    held = [(i, words(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n, length = len(held), sum(len(w) for _, w in held)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, w in held:
            m = 50 + (50 * len(w) * n) // length
            score = 0
            for term in wanted & set(w):
                df = sum(term in other for _, other in held)
                tf = w.count(term)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * ((10**9 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:keep], 1):
            out.append((item, rank, i, -score))
    return out


DOCS = [
    (1, "Alpha beta, gamma."), (2, "alpha ALPHA alpha_beta"), (3, None), (4, ""), (5, " .,; \n"), (6, "Éclair éclair ÄB äb 東京 naïve"),
    (7, "gamma " * 3000), (8, "x" * 5000), (None, "alpha beta gamma"), (9, "alpha beta, gamma."), (9, "alpha beta, gamma."),
    *[(100 + i, "common words alpha") for i in range(80)], *[(300 + i, f"beta {i} delta") for i in range(30)],
]
ITEMS = [(1, "ALPHA beta?"), (2, "éclair 東京 äb"), (3, None), (4, "...") , (5, "common"), (5, "delta 7"), (None, "gamma"), (6, "not there at-all qq")]


@pytest.mark.parametrize("parts, block_terms", [(1, 100_000), (6, 100_000), (3, 3)])
def test_ranks_equal_scores_one_by_one(spark, parts, block_terms):
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in DOCS], "doc_id long, text string, score string, rank int").repartition(parts)
    items = spark.createDataFrame([(i, t, 9) for i, t in ITEMS], "item_id long, text string, doc_id int")
    got = [tuple(r) for r in lexical.rank(docs, items, block_terms=block_terms).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(plain(DOCS, ITEMS), key=key)


def test_terms_cut_into_several_tiles_add_up(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TILE_TERMS", 2)
    monkeypatch.setattr(lexical, "TILE_ITEMS", 2)
    docs, items = [(i, f"a b c d e f{i % 3} " * (i % 4 + 1)) for i in range(40)], [(1, "a b c d e f1 f2"), (2, "f0 c"), (3, "e")]
    got = lexical.rank(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), keep=5)
    assert sorted(map(tuple, got.collect())) == sorted(plain(docs, items, 5))


def test_long_texts_are_split_at_blanks(monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK", 7)
    text = "Lorem ipsum dolor, sit amet lorem É" * 9
    assert dict(lexical.terms(text.encode())) == {w.encode(): words(text).count(w) for w in words(text)}


def test_cuts_stay_below_the_bound():
    import numpy as np

    weights = np.full(5000, 30_000)
    for tile in lexical.tiles({0: set(range(5000))}, weights):
        assert len(tile.terms) * int(weights.max()) * lexical.IMPACT < 1 << 53


def test_nothing_asked_or_held(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.rank(docs, items.limit(0)).collect() == []
    assert lexical.rank(docs.limit(0), items).collect() == []
    assert lexical.rank(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
