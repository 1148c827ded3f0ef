"""Near-duplicate documents by SuperMinHash (operator 10).

Texts with equal shingle sets form one class with one representative. Signatures of the
representatives are cut into bands; documents that share a band are candidates. Pairs are
confirmed on full sets, and links are joined into components by star contraction.

Groups are not expanded into pairs. First each representative is compared with one centre:
of the centres of its bands (in each band the document with most company) the one whose
signature is nearest. Then only pairs of the same band that still lie in different
components are compared, in blocks of bounded size, sketches before texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, small_batches, table

SHINGLE = 5  # words; the registered query takes 4
SIMILAR = 80  # percent of the union
BANDS, ROWS = 40, 5
SLOTS = BANDS * ROWS
NEAR = 0.6  # share of equal slots below which a pair is not confirmed: 7 deviations under 0.8
PARITY = 2048  # bits that hold whether their number of shingles is odd
BLOCK = 2048  # documents of a band, or members of a centre, that are compared in one group
SENT = 500_000  # requests for texts that are broadcast, at most: about 30 bytes each
TOGETHER = 4096  # elements of small sets that take their rounds together
CACHED = 100_000  # words whose hashes a task keeps
GOLDEN, MIX_A, MIX_B = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, size: int, known: Words) -> np.ndarray:
    """Ascending hashes of the distinct shingles; A-Z are lower-cased, words end at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    folded = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        folded = mixed(folded * GOLDEN + hashes[i : i + len(folded)])
    folded.sort()
    return folded[np.concatenate([[True], folded[1:] != folded[:-1]])]


def signature(elements: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    return signatures([elements], slots)[0]


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of sets, a row each; sets of like size take their rounds together."""
    least = np.full((len(sets), slots), np.inf)
    sizes = np.array([len(s) for s in sets])
    by_size = np.argsort(sizes, kind="stable")
    group = np.cumsum(sizes[by_size]) // TOGETHER
    for some in np.split(by_size, np.flatnonzero(np.diff(group)) + 1):
        least[some] = in_rounds([sets[i] for i in some], slots)
    return least


def in_rounds(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """The least value of each set at each slot.

    In round j each element puts j plus a random share of 1 at one slot, the j-th of its own
    random permutation. Once all slots of a set are below the next round's number, no later
    round can change one, and its elements stop.
    """
    least = np.full(len(sets) * slots, np.inf)
    elements = np.concatenate(sets)
    base = np.repeat(np.arange(len(sets)) * slots, [len(s) for s in sets])
    order = own = None
    for j in range(slots):
        random = mixed(elements + np.uint64((2 * j + 1) * int(GOLDEN) % (1 << 64)))
        share = (random >> np.uint64(11)).astype(np.float64) * 2.0**-53
        pick = (j + (mixed(random) >> np.uint64(40)) * np.uint64(slots - j) // np.uint64(1 << 24)).astype(np.int64)
        if order is None:
            slot = pick
        else:
            slot = order[own, pick]
            order[own, pick] = order[:, j]
        np.minimum.at(least, base + slot, share + j)
        going = (least.reshape(-1, slots).max(axis=1) >= j + 1)[base // slots]
        left = np.count_nonzero(going)
        if not left:
            break
        if order is None:  # most sets of many elements are done by now
            elements, base, pick = elements[going], base[going], pick[going]
            order, own = np.tile(np.arange(slots, dtype=np.uint16), (left, 1)), np.arange(left)
            order[own, pick] = 0
        elif 2 * left < len(elements):
            elements, base, order, own = elements[going], base[going], order[going], own[:left]
    return least.reshape(-1, slots)


def parities(found: np.ndarray) -> bytes:
    counts = np.bincount((found & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY)
    return np.packbits(counts & 1).tobytes()


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n, set, bands, slots, odd``: the set's size and hash, band keys, a byte of each slot, parities."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            sets = [shingle_set(text.as_py(), size, known) for text in batch.column(1)]
            sizes = np.array([len(found) for found in sets], np.int64)
            some = sizes > 0
            # a row for each set that is not empty: values of the slots, keys of the bands
            values = mixed(signatures([found for found in sets if len(found)]).view(np.uint64)) if some.any() else np.zeros((0, SLOTS), np.uint64)
            keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(values), 1))
            for i in range(ROWS):
                keys = mixed(keys * GOLDEN + values[:, i::ROWS])
            low = (values & np.uint64(255)).astype(np.uint8)
            place = np.cumsum(some) - 1
            bytes_ = [low[i].tobytes() if any_ else None for i, any_ in zip(place, some)]
            hashes = [xxhash.xxh3_128_hexdigest(found.tobytes()) if len(found) else None for found in sets]
            odd = [parities(found) if len(found) else None for found in sets]
            offsets = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
            flat = keys.reshape(-1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(hashes, pa.string()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(bytes_, pa.binary()), pa.array(odd, pa.binary())],
                names=["doc_id", "n", "set", "bands", "slots", "odd"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        sketch, f"doc_id {kind}, n bigint, set string, bands array<bigint>, slots binary, odd binary")


class Sketches:
    """Sizes, slots and parities of some documents, to tell which pairs to confirm on full sets."""

    def __init__(self, n, slots, odd):
        self.n = np.asarray(n, np.int64)
        self.slots = np.frombuffer(b"".join(slots), np.uint8).reshape(len(self.n), -1)
        self.odd = np.frombuffer(b"".join(odd), np.uint64).reshape(len(self.n), -1)

    def may_link(self, at, other: "Sketches", to) -> np.ndarray:
        """Which of the rows ``to`` of ``other`` may be similar to the rows ``at``.

        Where parities differ, the sets differ in one shingle at least: that bounds the
        similarity from above, and loses no pair.
        """
        sizes = self.n[at] + other.n[to]
        apart = np.bitwise_count(self.odd[at] ^ other.odd[to]).sum(axis=-1, dtype=np.int64)
        near = 100 * (sizes - apart) >= SIMILAR * (sizes + apart)
        agree = np.zeros(len(near))
        agree[near] = self.agree(at, other, to, near)
        return np.where(agree >= NEAR, agree, 0.0)

    def agree(self, at, other: "Sketches", to, chosen) -> np.ndarray:
        mine = self.slots[at] if np.ndim(at) == 0 else self.slots[at[chosen]]
        return (mine == other.slots[to[chosen]]).mean(axis=-1)


def close_pairs(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """``left, right`` pairs with ``agree``, the share of equal slots; those far apart go."""

    def agree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                a, b = (Sketches(batch[c + "n"], batch[c + "slots"], batch[c + "odd"]) for c in "ab")
                every = np.arange(len(batch))
                found = pd.DataFrame({"left": batch["left"], "right": batch["right"], "agree": a.may_link(every, b, every)})
                yield found[found.agree > 0]

    of = lambda side, letter: reps.select(F.col("rep").alias(side), *[F.col(c).alias(letter + c) for c in ("n", "slots", "odd")])
    kind = reps.schema["rep"].dataType.simpleString()
    both = pairs.join(of("left", "a"), "left").join(of("right", "b"), "right")
    return both.mapInPandas(agree, f"left {kind}, right {kind}, agree double")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """Those ``owner, member`` pairs whose full shingle sets are similar.

    Texts travel once for each pair, to their owner's group; an owner with many members has
    several groups.
    """
    counts = pairs.groupBy("owner").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("groups"))
    grouped = pairs.join(counts, "owner").select(
        "owner", "member", F.pmod(F.xxhash64("member"), F.col("groups")).cast("int").alias("part"), F.lit(1).alias("kind"))
    owners = counts.select("owner", F.col("owner").alias("member"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(0).alias("kind"))
    asked = materialize(grouped.unionByName(owners), "asked")
    # up to a counted size the requests go to the texts, beyond it both are shuffled
    sent = F.broadcast(asked) if asked.count() <= SENT else asked
    rows = docs.select(F.col("doc_id").alias("member"), "text").join(sent, "member")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, group, own = Words(), None, []
        for batch in batches:
            links = []
            for owner, part, kind, member, text in zip(batch.owner, batch.part, batch.kind, batch.member, batch.text):
                if (owner, part) != group:
                    group, own = (owner, part), []
                found = shingle_set(text, size, known)
                if kind == 0:
                    own.append(found)
                elif any(similar(found, other) for other in own):
                    links.append((owner, member))
            yield pd.DataFrame(links, columns=["owner", "member"])

    kind = pairs.schema["owner"].dataType.simpleString()
    return (
        rows.select("owner", "part", "kind", "member", "text").repartition("owner", "part")
        .sortWithinPartitions("owner", "part", "kind").mapInPandas(compare, f"owner {kind}, member {kind}")
    )


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < SIMILAR * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    places = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int(np.count_nonzero(large[places] == small))
    return 100 * common >= SIMILAR * (len(a) + len(b) - common)


def components(links: DataFrame) -> DataFrame:
    """``owner, member`` links -> ``node, component``: the least node reachable, for all linked nodes.

    Large and small star steps by turns, each a minimum by node and a join, until nothing
    changes; every step is written, which cuts the lineage.
    """
    edges = materialize(
        links.select(F.greatest("owner", "member").alias("u"), F.least("owner", "member").alias("v")).filter("u <> v").distinct(), "edges")
    state = lambda: tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = state()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = materialize(small.select("e.*").filter("u <> v").distinct(), "edges")
        now = state()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def across(members: DataFrame) -> DataFrame:
    """``key, node, component, n, slots, odd`` -> pairs that may link, of one key and different components.

    A key with more than ``BLOCK`` members is cut into blocks; each pair of blocks is a group.
    """
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    open_ = counts.filter("rows > 1 and lo <> hi").select("key", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        members.join(open_, "key").withColumn("own", block).withColumn("other", others)
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "component", "n", "slots", "odd")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            key = rows[["key", "i", "j"]]
            starts = np.flatnonzero((key != key.shift()).any(axis=1).to_numpy())
            rest = rows.iloc[starts[-1] :] if len(starts) else None
            if len(starts) > 1:
                yield near_pairs(rows, starts)
        if rest is not None and len(rest):
            yield near_pairs(rest.reset_index(drop=True), np.array([0, len(rest)]))

    kind = members.schema["node"].dataType.simpleString()
    return (
        dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        .mapInPandas(compare, f"left {kind}, right {kind}").distinct()
    )


def near_pairs(rows: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
    node, component = rows.node.to_numpy(), rows.component.to_numpy()
    known = Sketches(rows.n, rows.slots, rows.odd)
    lefts, rights = [], []
    for start, end in zip(bounds[:-1], bounds[1:]):
        for i in range(start, end - 1):
            other = np.arange(i + 1, end)
            other = other[component[other] != component[i]]
            if len(other):
                other = other[known.may_link(i, known, other) > 0]
                lefts.append(np.minimum(node[other], node[i]))
                rights.append(np.maximum(node[other], node[i]))
    if not lefts:
        return pd.DataFrame({"left": node[:0], "right": node[:0]})
    return pd.DataFrame({"left": np.concatenate(lefts), "right": np.concatenate(rights)}).drop_duplicates()


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, a row for each row of ``docs``.

    Null, empty and wordless texts have no shingles and are alone. Rows with one id are one
    document with several texts. A null id is linked with nothing and kept; other columns
    are ignored; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    rows = materialize(sketches(texts, size), "sketches")
    whole = rows.filter("set is not null and doc_id is not null")
    classes = whole.groupBy("set").agg(F.min("doc_id").alias("rep"))
    reps = materialize(
        whole.join(classes, "set").filter("doc_id = rep").dropDuplicates(["set"]).select("rep", "set", "n", "bands", "slots", "odd"), "reps")
    bands = reps.select("rep", F.explode("bands").alias("key"))
    company = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(bands.join(company, "key"), "bands")
    # in each band the document with most company in all bands is the centre
    weights = shared.groupBy("rep").agg(F.sum("n").alias("weight"))
    weighted = shared.select("key", "rep").join(weights, "rep")
    centres = weighted.groupBy("key").agg(F.max(F.struct("weight", (-F.col("rep")).alias("minus"))).alias("best"))
    stars = (
        shared.select("key", "rep").join(centres, "key")
        .select(F.col("rep").alias("left"), (-F.col("best.minus")).alias("right")).filter("left <> right").distinct()
    )
    nearest = close_pairs(stars, reps).groupBy("left").agg(F.max_by("right", F.struct("agree", "right")).alias("owner"))
    links = materialize(confirmed(nearest.select("owner", F.col("left").alias("member")), texts, size), "links")
    first = materialize(components(links), "first")
    placed = shared.select("key", F.col("rep").alias("node")).join(first, "node", "left").join(
        reps.select(F.col("rep").alias("node"), "n", "slots", "odd"), "node")
    members = placed.select("key", "node", F.coalesce("component", "node").alias("component"), "n", "slots", "odd")
    more = across(members).join(nearest.select("left", F.col("owner").alias("right")), ["left", "right"], "left_anti").join(
        nearest.select(F.col("left").alias("right"), F.col("owner").alias("left")), ["left", "right"], "left_anti")
    found = confirmed(more.select(F.col("left").alias("owner"), F.col("right").alias("member")), texts, size)
    # a document with several texts joins their classes
    own = whole.join(classes, "set").filter("doc_id <> rep").groupBy("doc_id").agg(F.min("rep").alias("owner"), F.max("rep").alias("member"))
    twins = own.filter("owner <> member").select("owner", "member")
    # stars of the first links stand for them, so that only what is new takes further steps
    stars = first.select(F.col("component").alias("owner"), F.col("node").alias("member"))
    final = components(stars.unionByName(found).unionByName(twins))
    of_class = classes.join(final, classes.rep == final.node, "left").select("set", F.coalesce("component", "rep").alias("component_id"))
    return rows.select("doc_id", "n", "set").join(of_class, "set", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_copies(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row of each group of near copies: that of least id, a null id last.

    Rows are told apart by themselves: rows that share an id, or have none, are documents of
    their own, so different texts stay and copies without an id go. Texts without a word stay,
    each row of them. Where ids repeat or are missing, the rows are written once with a key.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null")
    if ids.isEmpty():
        chosen = materialize(near_duplicates(docs, size), "kept").filter("kept").select("doc_id")
        return docs.join(chosen, "doc_id").select(docs.columns)
    keyed = materialize(docs.withColumn("__key", F.monotonically_increasing_id()), "keyed")  # fixed by being written
    found = materialize(near_duplicates(keyed.select(F.col("__key").alias("doc_id"), "text"), size).select(
        F.col("doc_id").alias("__key"), F.col("component_id").alias("__group")), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__key")
    least = found.join(keyed.select("__key", "doc_id"), "__key").groupBy("__group").agg(F.min(order).alias("first"))
    return keyed.join(least.select(F.col("first.__key").alias("__key")), "__key").select(docs.columns)


def op10_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 4)
