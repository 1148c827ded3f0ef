"""The pipeline against what each stage must keep of its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
from test_operators import filled, groups, shingles, split
from townvoice.llm import decontamination, neardup, toxicity
from townvoice.session import materialize


def test_stages(spark, sf_dir, docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    before, ids = docs, lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, before, sf_dir), name)
        assert set(docs.columns) <= set(after.columns)
        if name == "toxicity":
            scored = toxicity.score(before, toxicity.train(before, labels))
            assert ids(after) == ids(scored.filter("toxicity < 0.5"))
        elif name == "near_duplicates":
            assert ids(after) == ids(neardup.near_duplicates(before).filter("kept"))
        elif name == "decontamination":
            found = {r.doc_id for r in decontamination.contaminations(before, bench).collect()}
            assert found and ids(after) == [i for i in ids(before) if i not in found]
        elif name == "mixing":
            assert set(ids(after)) <= set(ids(before)) and after.groupBy("doc_id").count().filter("count > 3").count() == 0
        else:
            assert ids(after) == ids(before) and after.select("shard", "slot").distinct().count() == after.count()
        if name != "sharding":
            assert after.columns == docs.columns
        before = after


def test_registered():
    names = [n.split("_")[0] for n in entry.queries() if n.startswith("op")]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)] and "pipeline" in entry.queries()


def test_run_against_plain_python(spark, sf_dir, docs, monkeypatch):
    """Every stage of one run, worked out from the rows that it was given."""
    stages, write = {}, corpus_pipeline.materialize
    monkeypatch.setattr(corpus_pipeline, "materialize", lambda df, name: stages.setdefault(name, write(df, name)))
    result = corpus_pipeline.run(spark, sf_dir)
    rows = {name: {r.doc_id: r for r in df.collect()} for name, df in stages.items()}
    assert list(rows) == [name for name, _ in corpus_pipeline.STAGES] and result.columns == [*docs.columns, "size", "shard", "slot"]

    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    every = {r.doc_id: r for r in docs.collect()}
    left, bad = rows["toxicity"], [i for i, t in toxic.items() if t == 1 and i in every]
    clean = [i for i, t in toxic.items() if t == 0 and i in every]
    assert sum(i not in left for i in bad) >= 0.9 * len(bad) and sum(i in left for i in clean) >= 0.97 * len(clean)

    sets = {i: shingles(r.text, 5) for i, r in left.items()}
    wanted = {i for i, least in groups(sets).items() if i == least}
    assert set(rows["near_duplicates"]) == wanted and all(rows["near_duplicates"][i] == left[i] for i in wanted)

    items = [r.text.lower().split() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = {" ".join(w[k : k + 8]): len(w) for w in items for k in range(max(1, len(w) - 7))}
    for i, r in rows["near_duplicates"].items():
        words = r.text.lower().split()
        held = {window for k in range(max(1, len(words) - 7)) if (window := " ".join(words[k : k + 8])) in windows}
        if not held:
            assert i in rows["decontamination"], i
        elif any(" ".join(w) in " ".join(words) for w in items):
            assert i not in rows["decontamination"], i

    before, copies = rows["decontamination"], Counter(r.doc_id for r in stages["mixing"].collect())
    size = {i: len(split(r.text)) for i, r in before.items()}
    sizes, taken = Counter(), Counter()
    for i, r in before.items():
        sizes[r.source] += size[i]
        taken[r.source] += size[i] * copies[i]
    target = filled(sizes)
    assert set(copies) <= set(before) and max(copies.values()) <= 3
    assert all(abs(taken[s] - target[s]) <= max(size[i] for i, r in before.items() if r.source == s) for s in sizes)

    placed = result.collect()
    assert Counter(r.doc_id for r in placed) == copies and len({(r.shard, r.slot) for r in placed}) == len(placed)
    by_shard = Counter(r.shard for r in placed)
    assert max(by_shard.values()) - min(by_shard.values()) <= 1 and all(r.slot < by_shard[r.shard] for r in placed)
