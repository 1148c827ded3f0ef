"""Each operator against a brute-force version, and on edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from townvoice.llm import decontamination, language, mixing, neardup, quality, queries, repeats, sharding, tokens, toxicity, urls


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def removed(texts, size=100):
    """Of each document, by id: kept bytes, removed bytes, spans."""
    seen, out = set(), {}
    for i in sorted(texts):
        data = texts[i].encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - size + 1):
            piece = data[p : p + size]
            if piece in seen:
                gone[p : p + size] = True
            seen.add(piece)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(data) else 0
        out[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_repeats_are_removed_exactly(spark, sf_dir, texts):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op1_previous_factors(spark, sf_dir).collect()}
    assert got == removed(texts)


def test_repeats_of_hot_anchors(spark, monkeypatch, docs, texts):
    monkeypatch.setattr(repeats, "MANY", 0)
    monkeypatch.setattr(repeats, "SENT", 0)
    got = {r.doc_id: len(r.kept) for r in repeats.without_repeats(docs).select("doc_id", "kept").collect()}
    assert got == {i: v[0] - v[1] for i, v in removed(texts).items()}


def test_repeats_inside_one_text_and_periodic_texts():
    data = [b"a" * 500, b"ab" * 300, random.Random(1).randbytes(400) * 3]
    starts = repeats.repeated_starts(data)
    seen, plain = set(), []
    for d in data:
        for p in range(len(d) - 99):
            plain.append(d[p : p + 100] in seen)
            seen.add(d[p : p + 100])
    assert starts.tolist() == plain and sum(plain) > 1000


def test_repeats_edge_cases(edge_docs, no_docs):
    rows = repeats.without_repeats(edge_docs).collect()
    assert len(rows) == 11
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].n_bytes == 0 and bytes(by_id[4].kept) == b"" and not by_id[None].spans
    # the text repeats itself after 57 bytes; rows of one id are not each other's earlier copy
    assert by_id[1].spans[0].start == 57 and by_id[2].spans[0].start == 0 and len(by_id[6].kept) < 200
    assert repeats.without_repeats(no_docs).count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_texts_that_share_an_id_keep_what_is_their_own(spark, parts):
    r = random.Random(4)
    a, b = ("".join(r.choice("abcdefgh ") for _ in range(300)) for _ in range(2))
    rows = [(1, a), (2, a + "zz"), (2, b), (2, b), (None, a), (None, None), (3, None)]
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    assert sorted((x.doc_id or 0, x.n_bytes, len(x.kept)) for x in got) == [(0, 0, 0), (0, 300, 300), (1, 300, 300), (2, 300, 300), (2, 300, 300), (2, 302, 2), (3, 0, 0)]


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_copies_are_told_by_rows_and_not_by_ids(spark, parts):
    r = random.Random(5)
    a, b, c = (" ".join(str(r.randrange(10**6)) for _ in range(40)) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "y"), (None, a + " more", "z"), (None, c, "z"), (None, c, "z"), (7, c, "w"), (8, "", "v"), (8, None, "v"), (9, b, "u"), (9, b, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
    got = sorted(((x.doc_id, x.text, x.source) for x in neardup.without_copies(docs).collect()), key=str)
    assert got == sorted([(1, a, "x"), (1, b, "y"), (7, c, "w"), (8, "", "v"), (8, None, "v")], key=str)


def test_mix_tilts_by_size_and_meets_its_targets(spark):
    r = random.Random(6)
    rows = [(i, "w " * r.choice([5, 40, 300, 2000]), "abc"[i % 3], i % 7) for i in range(900)] + [(5000 + i % 3, "w " * 100, "d", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string, other int")
    seen = set()
    for parts in (1, 3, 7):
        found = mixing.balance(docs.repartition(parts)).collect()
        seen.add(tuple(sorted((x.doc_id, x.copies, round(x.rate, 9)) for x in found)))
    assert len(seen) == 1 and len(found) == 960
    for source in "abcd":
        own = [x for x in found if x.source == source]
        total = sum(x["size"] for x in own)
        assert abs(sum(x.rate * x["size"] for x in own) - own[0].target) < 1e-6 * own[0].target
        assert abs(sum(x.copies * x["size"] for x in own) - own[0].target) <= max(x["size"] for x in own)
        assert all(math.floor(x.rate) <= x.copies <= math.ceil(x.rate) for x in own)
        rates = {x["size"]: x.rate for x in own}
        tilt = [math.log(rate) / size for size, rate in rates.items() if 0 < rate < 3]
        assert not tilt or max(tilt) - min(tilt) < 1e-9 and (len(rates) == 1 or (tilt[0] > 0) == (own[0].target > total))


def test_dual_is_solved_for_odd_sizes(spark):
    groups = spark.createDataFrame([("a", 1, 10**6), ("a", 20_000, 3), ("b", 7, 5), ("c", 3, 4), ("c", 9000, 50), ("e", 10, 10)], "source string, size long, n long")
    size = {"a": 1_060_000, "b": 35, "c": 450_012, "e": 100}
    goals = spark.createDataFrame([("a", size["a"], 30_000.0), ("b", 35, 105.0), ("c", size["c"], 2.9 * size["c"]), ("d", 0, 0.0), ("e", 100, 100.0)], "source string, source_size long, target double")
    found = {x.source: x for x in mixing.multipliers(groups, goals).collect()}
    assert all(x.residual <= 1e-9 for x in found.values()) and found["d"].multiplier is None and found["e"].multiplier == 0
    assert found["a"].multiplier < 0 < found["c"].multiplier


def test_language_sample_does_not_depend_on_repeated_rows(spark):
    texts = [(i, "en", f"alpha beta gamma {'x' * (i % 9)}") for i in range(40)] + [(100 + i, "de", f"uber strasse {'y' * (i % 9)}") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id int, lang string, text string")
    many = docs.unionByName(docs.filter("doc_id = 1").withColumn("doc_id", F.explode(F.sequence(F.lit(1), F.lit(300)))).withColumn("doc_id", F.lit(1)))
    one, other = language.train(docs, sample=10), language.train(many.repartition(3), sample=10)
    assert one.languages == other.languages == ["de", "en"] and (one.slots == other.slots).all()
    assert language.guess("strasse", one)[0] == "de"


def test_benchmark_items_are_found(spark, sf_dir, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    index = defaultdict(set)
    for i, text in items.items():
        w = text.lower().split()
        for k in range(max(1, len(w) - 7)):
            index[" ".join(w[k : k + 8])].add(i)
    want = set()
    for d, text in texts.items():
        w = text.lower().split()
        for k in range(max(1, len(w) - 7)):
            want |= {(d, i) for i in index.get(" ".join(w[k : k + 8]), ())}
    got = {(r.doc_id, r.item_id) for r in queries.op2_templates(spark, sf_dir).collect()}
    assert got == want and want


def test_reparameterised_questions(spark, edge_docs, no_docs):
    item = "A train with 12 cars leaves Paris at 9 hours and travels 300 km to Lyon before the 12 cars return to Paris again."
    other = "We read: a train with 15 cars leaves Rome at 7 hours and travels 420 miles to Milan before the 15 cars return to Rome again."
    broken = "A train with 15 cars leaves Rome at 7 hours and travels 420 miles to Milan before the 99 cars return to Oslo again."
    clean = "The river with many boats leaves the lake at dawn and flows to the sea before the boats return."
    docs = spark.createDataFrame([(1, other), (2, clean), (3, item), (4, None), (5, broken)], "doc_id int, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "9 10 11")], "item_id int, text string")
    got = {(r.doc_id, r.item_id): r.consistent for r in decontamination.contaminations(docs, bench).collect()}
    assert {(1, 7), (3, 7)} <= set(got) <= {(1, 7), (3, 7), (5, 7)} and got[3, 7] == 1.0
    assert {r.doc_id for r in decontamination.decontaminated(docs, bench).collect()} >= {2, 4}
    blocks = decontamination.contaminations(docs, bench.unionByName(spark.createDataFrame([(11, clean)], bench.schema)), block=1)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} >= {(1, 7), (2, 11), (3, 7)}
    assert decontamination.contaminations(edge_docs, bench).count() == 0
    assert decontamination.decontaminated(no_docs, bench).count() == 0
    assert decontamination.decontaminated(edge_docs, bench.limit(0)).count() == 11


def inserted(words, gap):
    return [x for k, w in enumerate(words) for x in ([f"extra{k}", w] if k and k % gap == 0 else [w])]


def test_copies_with_inserted_and_left_out_words(spark):
    item = [f"word{k}" for k in range(38)]
    asked = "our old train with 12 heavy cars leaves Paris at 9 and it slowly travels 300 km to Lyon before all those 12 heavy cars return to Paris again".split()
    swap = {"12": "15", "Paris": "Rome", "9": "7", "300": "420", "Lyon": "Milan"}
    other = [swap.get(w, w) for w in asked]
    cases = {
        1: inserted(item, 10), 2: inserted(item, 13), 3: [w for k, w in enumerate(item) if k % 10 != 9],
        4: item[:10] + item[28:], 5: inserted(other, 9), 6: other[:9] + other[11:],
        # half of an item far from the other half, in the wrong order, or with other substitutions, is no copy
        7: item[:10] + ["x"] * 500 + item[28:], 8: item[24:] + item[:14], 9: ["y"] * 9 + item[:18],
    }
    docs = spark.createDataFrame([(i, " ".join(["start", "of", *w, "end"])) for i, w in cases.items()], "doc_id int, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(asked))], "item_id int, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminations(docs, bench).collect()}
    assert set(got) == {(i, 1) for i in (1, 2, 3, 4)} | {(5, 2), (6, 2)}
    assert got[1, 1].covered == got[2, 1].covered == 1.0 and got[4, 1].covered == 20 / 38 and got[5, 2].consistent == 1.0
    assert {r.doc_id for r in decontamination.decontaminated(docs, bench).collect()} == {7, 8, 9}


def test_items_dense_in_slots_and_copies_in_other_case(spark):
    items = {
        1: "12 30 7 45 9 10 11 88 3 64", 2: "Anna Berta Carl Dora Emil Frieda Gustav Hanna Ida", 3: "What is 12 plus 30",
        4: "The old train with many cars leaves the small station at dawn and comes back late in the evening.",
        5: "Totals 4 5 6 7 8 of 9 10 11 12 13", 6: "The Long History Of Modern Towns And Rivers",
    }
    copies = {
        1: [items[1]], 2: [items[2], items[2].upper()], 3: [items[3], "WHAT IS 12 PLUS 30", "What is 15 plus 41"],
        4: [items[4].upper(), items[4].title(), items[4].lower()], 5: [items[5], "Totals 1 2 3 8 9 of 77 78 79 80 81"], 6: [items[6], items[6].lower()],
    }
    # as many numbers or names of other values, or a heading of the same shape, are no copy
    rows = [(i, "Heading " + text + " and more") for i, texts in copies.items() for text in texts] + [
        (0, "Heading 13 31 8 46 19 20 21 89 4 65 and more"), (0, "Heading Karl Lena Maria Nora Otto Paul Quirin Rosa Sven and more"),
        (0, "The New Guide To Ancient Cities With Maps"), (0, "THE NEW GUIDE TO ANCIENT CITIES WITH MAPS")]
    docs = spark.createDataFrame([(k, want, text) for k, (want, text) in enumerate(rows)], "doc_id int, want int, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminations(docs, bench).collect()}
    assert got == {(k, want) for k, (want, _) in enumerate(rows) if want}
    assert {r.want for r in decontamination.decontaminated(docs, bench).collect()} == {0}


def test_items_of_repeated_words(spark):
    docs = spark.createDataFrame([(1, "a b " * 3000)], "doc_id int, text string")
    bench = spark.createDataFrame([(1, "a b " * 20 + "c d e"), (2, "a b " * 8 + "c d e f " * 8)], "item_id int, text string")
    assert [tuple(r) for r in decontamination.contaminations(docs, bench).collect()] == [(1, 1, 40 / 43, 1.0)]


def test_toxicity_learns(spark, docs, edge_docs, no_docs):
    bad, good = ["idiot", "moron", "scum", "clown"], ["tree", "river", "stone", "cloud", "house"]
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(good) for _ in range(30)) + (" " + r.choice(bad) if i % 4 == 0 else "")) for i in range(400)]
    made = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = made.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.train(made, labels)
    held = toxicity.score(made, model).filter("crc32(cast(doc_id as string)) % 5 = 0").collect()
    assert len(held) > 40 and all((x.toxicity >= 0.5) == (x.doc_id % 4 == 0) for x in held)
    edge = toxicity.score(edge_docs, model)
    assert edge.count() == 11 and edge.filter("toxicity between 0 and 1").count() == 11
    assert toxicity.score(no_docs, model).count() == 0
    nothing = toxicity.train(made, labels.limit(0))
    assert toxicity.score(made, nothing).filter("toxicity >= 0.5").count() == 0


def test_toxicity_query(spark, sf_dir, texts):
    rows = queries.op3_naive_bayes_linear(spark, sf_dir).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


@pytest.fixture(scope="module")
def library():
    with open(tokens.VOCABULARY, encoding="utf-8") as file:
        return Tokenizer.from_file(tokens.VOCABULARY), tokens.Prefixes(file.read())


def test_prefix_counts_are_those_of_the_library(library):
    tokenizer, prefixes = library
    parts = ["a", " ", "  ", "\n\n", "'re", "'s", "'", "é", "日本", "1", "23", "!!", "\t", "<|endoftext|>", "<|end", "\x1c", "\x85", "Ⅷ", "the", "🙂", "\u0558"]
    r = random.Random(5)
    for _ in range(300):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 10)))
        want = [len(tokenizer.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert prefixes.counts(text).tolist() == want, repr(text)
    assert prefixes.counts("a" * 5000)[-1] == len(tokenizer.encode("a" * 5000).ids)


def test_texts_with_many_special_strings(library):
    tokenizer, prefixes = library
    text = "a doc.\n<|endoftext|>" * 5000 + "end"
    counts = prefixes.counts(text)
    r = random.Random(7)
    for i in [0, 20, len(text) - 4, len(text), *(r.randrange(len(text)) for _ in range(10))]:
        assert counts[i] == len(tokenizer.encode(text[:i], add_special_tokens=False).ids), i
    assert len(counts) == len(text) + 1 and prefixes.counts("<|endoftext|>" * 2)[[0, 13, 26]].tolist() == [0, 1, 2]


def test_tokens_of_whole_texts(spark, sf_dir, texts, library, edge_docs, no_docs):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op4_prefix_tokens(spark, sf_dir).collect()}
    count = {i: len(library[0].encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    assert got == {i: (len(t.encode()), count[i], count[i] > 512) for i, t in texts.items()}
    rows = tokens.prefix_tokens(edge_docs).select("doc_id", tokens.total(F.col("prefix_tokens")).alias("n"), tokens.fitting(F.col("prefix_tokens"), 2).alias("fit")).collect()
    assert len(rows) == 11 and {r.doc_id: r.n for r in rows}[3] == 0 and {r.doc_id: r.fit for r in rows}[7] == 7
    assert tokens.prefix_tokens(no_docs).count() == 0


def test_quality_counts(spark, sf_dir, texts, edge_docs, no_docs):
    for r in queries.op5_divergence(spark, sf_dir).collect():
        text, w = texts[r.doc_id], split(texts[r.doc_id])
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        inside = {i + j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(8)}
        lines = Counter(line for line in text.split("\n") if split(line))
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), sum(n - 1 for n in lines.values()), len(inside))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (len(w) < 20 or 100 * len(inside) > 30 * len(w))
        assert not (r.base_failed and r.kept)
    edge = quality.judge(edge_docs).collect()
    assert len(edge) == 11 and all(r.base_failed for r in edge if r.doc_id in (3, 4, 5, 7, 8, 9))
    assert quality.judge(no_docs).count() == 0


def test_jensen_shannon_distance(spark):
    p, q = [3.0, 1.0, 0.0], [1.0, 1.0, 2.0]
    a, b = np.array(p) / sum(p), np.array(q) / sum(q)
    m = (a + b) / 2
    want = math.sqrt(sum(x * math.log2(x / y) / 2 for side in (a, b) for x, y in zip(side, m) if x))
    array = lambda v: F.array(*map(F.lit, v))
    row = spark.range(1).select(quality.distance(array(p), array(q)).alias("d"), quality.distance(array(p), array([0.0] * 3)).alias("none")).first()
    assert abs(row.d - want) < 1e-12 and row.none is None


def filled(sizes):
    """Targets by the rule as stated: reshare the excess until none is above."""
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    done, rest = {}, sum(sizes.values())
    while True:
        open_ = [s for s in sizes if s not in done]
        level = rest / sum(weights[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weights[s] * level > 3 * sizes[s]]
        if not over:
            return {**done, **{s: weights[s] * level for s in open_}}
        for s in over:
            done[s] = 3 * sizes[s]
            rest -= done[s]


def test_mixing(spark, sf_dir, docs, texts, edge_docs, no_docs):
    rows = queries.op6_entropy_balancing(spark, sf_dir).collect()
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    size = {i: len(split(t)) for i, t in texts.items()}
    sizes, taken = Counter(), Counter()
    for i, n in size.items():
        sizes[source[i]] += n
    target = filled(sizes)
    for r in rows:
        s = source[r.doc_id]
        assert r["size"] == size[r.doc_id] and r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * target[s]
        assert r.taken <= 3 * r["size"]
        taken[s] += r.taken
    longest = max(size.values())
    assert len(rows) == len(texts) and all(abs(taken[s] - target[s]) <= longest / 2 for s in sizes)
    again = queries.op6_entropy_balancing(spark, sf_dir).collect()
    assert sorted(rows) == sorted(again)
    edge = mixing.balance(edge_docs).collect()
    assert len(edge) == 11 and all(r.copies <= 3 and (r["size"] or r.copies == 0) for r in edge)
    assert mixing.mixed(edge_docs).columns == edge_docs.columns and mixing.balance(no_docs).count() == 0


def test_a_source_at_its_limit(spark):
    rows = [(i, "w " * 100, "a") for i in range(2)] + [(10 + i, "w " * 100, "b") for i in range(30)] + [(50 + i, "w " * 100, None) for i in range(30)]
    got = mixing.balance(spark.createDataFrame(rows, "doc_id int, text string, source string")).collect()
    by = {r.source: (r.source_size, r.target) for r in got}
    want = filled({"a": 200, "b": 3000, None: 3000})
    assert all(abs(by[s][1] - want[s]) < 1e-6 for s in want) and want["a"] == 600
    assert sum(r.copies for r in got if r.source == "a") == 6


def test_sharding(spark, sf_dir, texts, edge_docs, no_docs, tmp_path):
    rows = queries.op7_external_shuffle(spark, sf_dir).collect()
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r.slot)
    assert sorted(r.doc_id for r in rows) == sorted(texts) and set(shards) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert all(r["size"] == len(texts[r.doc_id].encode()) + 1 for r in rows)
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.slot, r.shard))]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.3
    edge = sharding.external_shuffle(edge_docs, shards=3, bucket_bytes=1000)
    assert edge.count() == 11 and edge.filter("doc_id = 1").count() == 2 and "rate" in edge.columns
    sharding.write_shards(edge, f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").count() == 11
    assert sharding.external_shuffle(no_docs).count() == 0


def test_language(spark, sf_dir, docs, edge_docs, no_docs):
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in queries.op8_bloom_filters(spark, sf_dir).collect() if r.held_out]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    filters = language.train(docs)
    edge = {r.doc_id: r for r in language.identify(edge_docs, filters).collect()}
    assert edge[3].lang_pred == edge[4].lang_pred == edge[5].lang_pred == "und" and edge[3].score == 0.0
    assert language.identify(no_docs, filters).count() == 0
    assert language.guess("some words", language.train(no_docs)) == ("und", 0.0)


def plain_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def test_urls(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()}
    for r in queries.op9_url_trees(spark, sf_dir).collect():
        host, path = plain_url(pages[r.page_id])
        fits = [x for x in urls.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.host + x.path), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best and best.host + best.path)
        assert r.verdict == best.verdict if best else r.verdict == ("block" if r.score >= 0.5 else "allow")


def test_url_edges(spark):
    odd = [None, "", "http://", "no scheme", "HTTP://WWW.Example.COM/en/1?x=1#y", "http://com/", "http://a.net/es", "x://ÄB.com?q", "http://example.com/en/a", "http://example.com/en/a"]
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(odd)] + [(None, "http://b.net/fr/1", None, None)], "page_id int, url string, host string, score string")
    rows = urls.judge(pages).collect()
    assert len(rows) == len(odd) + 1
    for r in rows:
        if r.page_id is not None:
            assert (r.host, r.path) == plain_url(odd[r.page_id])
    assert urls.judge(pages.limit(0)).count() == 0


def groups(sets, percent=80):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def shingles(text, size):
    w = text.encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def test_near_duplicates(spark, sf_dir, texts):
    sets = {i: shingles(t, 4) for i, t in texts.items()}
    want = groups(sets)
    for r in queries.op10_superminhash(spark, sf_dir).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


@pytest.mark.parametrize("block", [2048, 7])
def test_chains_of_near_copies(spark, monkeypatch, block):
    """Documents that are alike only through others, whose similarities lie around the threshold."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "SENT", 0 if block == 7 else 500_000)
    r = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows, current = [], list(base)
    for i in range(60):
        current = list(base) if i % 20 == 0 else current
        for _ in range(r.randint(1, 4)):
            current[r.randrange(len(current))] = f"x{r.random()}"
        rows.append((i, " ".join(current)))
    sets = {i: shingles(t, 4) for i, t in rows}
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4).collect()
    assert {x.doc_id: x.component_id for x in got} == groups(sets)


def test_super_min_hash_estimates_similarity():
    r = np.random.default_rng(4)
    pool = r.integers(0, 1 << 63, 300).astype(np.uint64)
    a, b = neardup.signature(pool[:200]), neardup.signature(pool[40:240])
    assert abs((a == b).mean() - 160 / 240) < 0.12
    one = neardup.signature(pool[:1])
    assert sorted(np.floor(one).astype(int)) == list(range(neardup.SLOTS))


def test_near_duplicate_edges(edge_docs, no_docs):
    rows = neardup.near_duplicates(edge_docs, 4).collect()
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert len(rows) == 11 and found[2][1] == 1 and found[8][1:] == (7, False) and found[3] == (0, 3, True) and found[None][1:] == (None, True)
    kept = neardup.without_copies(edge_docs, 4)
    assert kept.columns == edge_docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [1, 3, 4, 5, 6, 7, 9]
    assert neardup.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_templates_do_not_depend_on_ids_copies_or_layout(spark, monkeypatch, parts):
    item, short = "The quick engineer of the northern harbour paints 14 long wooden boats before winter", "two boats"
    text = f"As told before, {item.lower()} and then rests."
    rows = [(1, text, "x")] * 3 + [(None, text, "x"), (1, "no boats here", "x"), (2, None, "x"), (3, "", "x"), (4, "I own two boats.", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, item_key string").repartition(parts)
    asked = [("a", item), ("a", item), ("a", short), (None, short), ("c", None), ("d", "...")]
    bench = spark.createDataFrame(asked, "item_id string, text string").repartition(parts)
    want = Counter({(1, "a"): 6, (None, "a"): 2, (4, "a"): 1, (4, None): 1})
    for bits in ((20, 28), (15, 15)):  # the size of the map changes nothing
        monkeypatch.setattr(decontamination, "MAP_BITS", bits)
        got = decontamination.contaminations(docs, bench, block=2).collect()
        assert Counter((r.doc_id, r.item_id) for r in got) == want and {(r.covered, r.consistent) for r in got} == {(1.0, 1.0)}
    left = decontamination.decontaminated(docs, bench)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter({(1, "no boats here"): 1, (2, None): 1, (3, ""): 1})


def test_suffix_statistics_leave_out_the_own_label(spark):
    rng = random.Random(5)
    urls_ = [f"https://{rng.choice(['a', 'b', 'c'])}.{rng.choice(['net', 'com', 'org'])}/{rng.choice(['fr', 'es', 'en'])}/{k}" for k in range(300)]
    pages = spark.createDataFrame(list(enumerate([*urls_, *urls_[:40], None, "", "x"])), "page_id int, url string")
    rows = [r.asDict() for r in urls.with_suffixes(urls.lexical(pages, urls.RULES)).collect()]
    assert len(rows) == 343 and len({r["fold"] for r in rows}) == urls.FOLDS
    for r in rows:
        used = [o for o in rows if o["label"] is not None and (r["label"] is None or o["fold"] != r["fold"])]
        assert r["label"] is None or r["url"] not in {o["url"] for o in used}
        mean = sum(o["label"] for o in used) / max(1, len(used))
        for suffix in ("top", "domain"):
            own = [o["label"] for o in used if o[suffix] == r[suffix]]
            assert r[f"{suffix}_blocked"] == pytest.approx((sum(own) + urls.PRIOR * mean) / (len(own) + urls.PRIOR))
            assert r[f"{suffix}_share"] == pytest.approx(math.log10(sum(o[suffix] == r[suffix] for o in rows) / len(rows)))


def test_learned_verdicts_do_not_follow_chance_labels(spark):
    # labels by a coin (a rule's path) say nothing of a host: the trees must not tell them apart by the suffixes
    rng = random.Random(11)
    rows = [(k, f"https://h{rng.randrange(40)}.net/{rng.choice(['fr', 'de'])}/p{rng.randrange(10**6)}") for k in range(1500)]
    rules = (urls.Rule("block", "net", "/fr/"), urls.Rule("allow", "net", "/de/"))
    pages = spark.createDataFrame(rows, "page_id int, url string")
    seen = [(r.label, r.domain_blocked) for r in urls.with_suffixes(urls.lexical(pages, rules)).collect()]
    bad, good = ([x for y, x in seen if y == want] for want in (1.0, 0.0))
    order = sorted(range(len(bad) + len(good)), key=lambda i: (bad + good)[i])
    auc = (sum(rank for rank, i in enumerate(order) if i < len(bad)) - len(bad) * (len(bad) - 1) / 2) / (len(bad) * len(good))
    assert 0.4 < auc < 0.6
