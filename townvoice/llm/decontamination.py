"""Benchmark decontamination by template canonicalisation (operator 2).

Words are lower-cased and lose their punctuation. Windows of them are hashed and joined by
hash with the windows of the benchmark under three keys: as they are, with numbers and units as
typed placeholders, and with names as placeholders too. So every item with a word is found
where it stands literally, in any case, and most also with other numbers or names. Matches
of one item on one diagonal (same distance of places) form runs, and runs on nearby diagonals
are chained in order of place, since inserted or left out words move what follows. The slots
of the chain are checked: each value of the item must stand for one value of the document.
An item is found if consistent matches cover enough of its tokens. A copy changed in every
window of eight tokens shares no window and is not found.

Windows of slots only are no evidence of another set of values. Names are told by capitals
alone, so windows that are mostly names, as in any heading, add to a copy that has another
match, but make none.

Texts and items take part under the hash of their text, so copies are judged once. A bit map
of the benchmark's windows keeps most other windows out of the join. Its size is bounded: past
that, more windows are joined in vain, and the result is the same.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, small_batches, table

WINDOW = 8  # tokens; an item with fewer is one window
LITERAL = 0.5  # share of plain words in a window with names, at least, for it to be evidence by itself
COVER = 0.5  # share of an item's tokens that matches cover, at least
CONSISTENT = 0.8  # share of slot pairs that follow one substitution, at least
BLOCK = 50_000  # windows that a task hands over at once, about
MAP_BITS = (20, 28)  # least and most bits, as powers of 2, of the map of the benchmark's windows: 32 MB
PER_WINDOW = 1024  # bits of the map for each window of the benchmark, up to the most
CACHED = 50_000  # words whose tokens a task keeps
# units that count as such after a number; fixed values
UNITS = frozenset("""% mm cm m km kg g mg l ml s ms min h hz kb mb gb tb usd eur gbp inch inches foot feet yard yards mile miles
ounce ounces pound pounds gram grams kilogram kilograms meter meters metre metres kilometer kilometers liter liters litre litres
second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros
percent degree degrees watt watts volt volts""".split())
NUMBER, UNIT, NAME = (xxhash.xxh3_64_intdigest(kind) for kind in (b"<number>", b"<unit>", b"<name>"))
NAMED = 2  # the key with names as slots
SEEDS = np.array([1, 2, 3], np.uint64)  # tell the windows of the three keys apart
POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
GOLDEN, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
EDGES = regex.compile(r"^[^\p{L}\p{M}\p{N}%]+|[^\p{L}\p{M}\p{N}%]+$")
STOP = regex.compile(r"[.!?:]\W*$")


class Tokens(NamedTuple):
    keys: tuple[np.ndarray, ...]  # hash of each token: as it is, with numbers and units as slots, with names too
    slots: tuple[np.ndarray, ...]  # whether it is a placeholder there
    codes: np.ndarray
    words: list[str]  # the word of each code

    def values(self) -> list[str]:
        """The word each token stands for."""
        return [self.words[code] for code in self.codes]


class Canonical(dict):
    """Codes of words, and what each can be: core, hash, number?, unit?, capital?, ends a sentence?"""

    def __init__(self):
        super().__init__()
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.cores: list[str] = []
        self.hashes, self.kinds = array("Q"), array("B")  # kinds: bits of the five answers

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self.cores)
        if word.isalpha():  # the usual words need no pattern
            core, stop = word, False
        elif word[-1] in ".,;!?:" and word[:-1].isalpha():
            core, stop = word[:-1], word[-1] in ".!?:"
        else:
            core, stop = EDGES.sub("", word), STOP.search(word) is not None
        low = core.lower()
        self.cores.append(low)
        self.hashes.append(xxhash.xxh3_64_intdigest(low.encode("utf-8", "surrogatepass")))
        first = core[:1]
        self.kinds.append(first.isdigit() | (low in UNITS) << 1 | first.isupper() << 2 | stop << 3 | (low != "") << 4)
        return code

    def tokens(self, text: str | None) -> Tokens:
        """Tokens of a text; words without a letter or digit are left out."""
        if len(self.cores) >= CACHED:
            self.forget()
        words = (text or "").split()
        codes = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        kinds = np.frombuffer(self.kinds, np.uint8)[codes] if words else np.zeros(0, np.uint8)
        number, unit, capital, stop, held = ((kinds & bit).astype(bool) for bit in (1, 2, 4, 8, 16))
        literal = np.frombuffer(self.hashes, np.uint64)[codes] if words else np.zeros(0, np.uint64)
        # the first word, and one after a sentence's end, is no name for its capital
        starts = np.concatenate([[True], stop[:-1]])[: len(words)]
        measure = unit & np.concatenate([[False], number[:-1]])[: len(words)] & ~number
        name = capital & ~starts & ~number & ~measure
        counted = np.where(number, np.uint64(NUMBER), np.where(measure, np.uint64(UNIT), literal))
        named = np.where(name, np.uint64(NAME), counted)
        counts = number | measure
        keys, slots = (literal, counted, named), (np.zeros(len(words), bool), counts, counts | name)
        if not held.all():
            keys, slots, codes = tuple(k[held] for k in keys), tuple(x[held] for x in slots), codes[held]
        return Tokens(keys, slots, codes, self.cores)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of GOLDEN and of its inverse, modulo 2**64."""
    if n > len(POWERS[0]):
        for i, base in enumerate((int(GOLDEN), pow(int(GOLDEN), -1, 1 << 64))):
            own = np.full(2 * n, base, np.uint64)
            own[0] = 1
            POWERS[i] = np.multiply.accumulate(own)
    return POWERS[0][:n], POWERS[1][:n]


def windowed(marks: np.ndarray, size: int) -> np.ndarray:
    """How many marks the window at each place has."""
    sums = np.concatenate([[0], np.cumsum(marks)])
    return sums[size:] - sums[:-size]


def windows(tokens: Tokens, size: int, key: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the windows that count under a key, their hashes, and which are evidence by themselves.

    Under the first key all count. Under the others, those with a word and with a slot that
    the key before does not have: without one they are the windows of that key.
    """
    ids, slot = tokens.keys[key], tokens.slots[key]
    n = len(ids) - size + 1
    if size < 1 or n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    own = slot & ~tokens.slots[key - 1]
    if key and not own.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    up, down = powers(len(ids))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * up, dtype=np.uint64)])
    folded = ((sums[size:] - sums[:-size]) * down[:n] + SEEDS[key]) * MIX
    folded ^= folded >> np.uint64(29)
    if not key:
        return np.arange(n), folded, np.ones(n, bool)
    words = size - windowed(slot, size)
    places = np.flatnonzero((words > 0) & (windowed(own, size) > 0))
    return places, folded[places], words[places] >= (LITERAL * size if key == NAMED else 1)


def entries_of(tokens: Tokens) -> tuple[int, np.ndarray, np.ndarray]:
    """The window length of an item, and the hashes and places of its windows under all keys."""
    size = min(WINDOW, len(tokens.codes))
    found = [windows(tokens, size, key) for key in range(len(tokens.keys))]
    return size, np.concatenate([f[1] for f in found]), np.concatenate([f[0] for f in found])


def item_windows(items: DataFrame) -> DataFrame:
    """``hash, size, item_key, place, total``: the windows of each item, with its number of tokens.

    ``items``: ``item_key, text``. Items without a word have none.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Canonical()
        for batch in batches:
            for key, text in zip(batch.item_key, batch.text):
                tokens = known.tokens(text)
                size, hashes, places = entries_of(tokens)
                if size:
                    yield pd.DataFrame({"hash": hashes.view(np.int64), "size": size, "item_key": key, "place": places, "total": len(tokens.codes)})

    return items.mapInPandas(cut, "hash bigint, size int, item_key string, place int, total int")


def item_tokens(items: DataFrame) -> DataFrame:
    """``item_key, slots, values``: the tokens of each item, and which are placeholders."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Canonical()
        for batch in batches:
            found = [known.tokens(text) for text in batch.text]
            yield pd.DataFrame({"item_key": batch.item_key, "slots": [t.slots[-1].tolist() for t in found], "values": [t.values() for t in found]})

    return items.mapInPandas(cut, "item_key string, slots array<boolean>, values array<string>")


def window_map(entries: DataFrame) -> tuple[int, np.ndarray]:
    """A bit for each value of the hashes' first bits, least bit of a byte first; how many bits those are."""
    bits = min(MAP_BITS[1], max(MAP_BITS[0], (PER_WINDOW * max(1, entries.count()) - 1).bit_length()))
    place = F.shiftrightunsigned("hash", 64 - bits) + 1
    parts = entries.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in parts.toLocalIterator():
        own = np.frombuffer(row.bits, np.uint8)
        out[(row.part - 1) * len(own) : row.part * len(own)] = own
    return bits, out


def text_windows(texts: DataFrame, entries: DataFrame, block: int = BLOCK) -> DataFrame:
    """``hash, size, text_key, at, strong, words``: the windows of each text that the map of ``entries`` holds.

    ``texts``: ``text_key, text``.
    """
    sizes = sorted(row.size_ for row in entries.select(F.col("size").alias("size_")).distinct().collect())
    shared = texts.sparkSession.sparkContext.broadcast(window_map(entries))
    kinds = {"hash": pa.int64(), "size": pa.int32(), "text_key": pa.string(), "at": pa.int32(), "strong": pa.bool_(), "words": pa.string()}

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows = Canonical(), []
        bits, held = shared.value
        for batch in batches:
            for text_key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = known.tokens(text.as_py())
                for size in sizes:
                    for key in range(len(tokens.keys)):
                        places, hashes, strong = windows(tokens, size, key)
                        bit = hashes >> np.uint64(64 - bits)
                        hit = np.flatnonzero(held[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                        for at, own, alone in zip(places[hit].tolist(), hashes[hit].view(np.int64).tolist(), strong[hit].tolist()):
                            words = " ".join([tokens.words[code] for code in tokens.codes[at : at + size].tolist()])
                            rows.append((own, size, text_key, at, alone, words))
                            if len(rows) >= block:
                                yield packed(rows)
                                rows = []
        yield packed(rows)

    return texts.mapInArrow(find, "hash bigint, size int, text_key string, at int, strong boolean, words string")


class Run(NamedTuple):
    """Consecutive places of an item that match a text at one distance."""

    shift: int  # place in the text less place in the item
    start: int  # first place in the item
    end: int
    strong: bool  # whether one of its windows is evidence by itself


def runs_of(places: np.ndarray, shifts: np.ndarray, sizes: np.ndarray, strong: np.ndarray) -> list[Run]:
    """The runs that the matching windows of one item form, by shift and place."""
    order = np.lexsort((places, shifts))
    found: list[Run] = []
    for shift, start, size, own in zip(*(x[order].tolist() for x in (shifts, places, sizes, strong))):
        if found and found[-1].shift == shift and start <= found[-1].end:
            last = found[-1]
            found[-1] = Run(shift, last.start, max(last.end, start + size), last.strong or bool(own))
        else:
            found.append(Run(shift, start, start + size, bool(own)))
    return found


def beside(run: Run, other: Run) -> Run:
    """What of ``run`` lies wholly before or wholly after ``other``, in the item and in the text; the longer part."""
    apart = other.shift - run.shift
    after = run._replace(start=max(run.start, other.end + max(0, apart)))
    before = run._replace(end=min(run.end, other.start + min(0, apart)))
    return max(before, after, key=lambda r: r.end - r.start)


def agreement(chain: list[Run], slot: np.ndarray, values: list[str], words: list[str]) -> float:
    """Share of the slot pairs of a chain that follow one substitution."""
    pairs = {(values[i], words[i + r.shift]) for r in chain for i in range(r.start, r.end) if slot[i]}
    both = len({a for a, _ in pairs}) + len({b for _, b in pairs})
    return both / (2 * len(pairs)) if pairs else 1.0


def chained(seed: Run, others: list[Run], band: int, fits) -> list[Run]:
    """``seed`` and those of ``others``, the longest first, that keep the order of places and the band of shifts."""
    chain, low, high = [seed], seed.shift, seed.shift
    for run in others:
        if max(high, run.shift) - min(low, run.shift) > band:
            continue
        for own in chain:
            run = beside(run, own)
            if run.start >= run.end:
                break
        else:
            if fits([*chain, run]):
                chain.append(run)
                low, high = min(low, run.shift), max(high, run.shift)
    return chain


def best_copy(runs: list[Run], slot: np.ndarray, values: list[str], words: list[str]) -> tuple[float, float] | None:
    """Covered and consistent share of the best copy of an item that its runs form, if one is enough.

    A copy is one run, runs of one shift, or runs of nearby shifts in order of place: inserted
    and left out words move what follows. Its shifts differ by the item's length at most.
    """
    total = len(values)

    def union(some: list[Run]) -> float:
        held = np.zeros(total, bool)
        for r in some:
            held[r.start : r.end] = True
        return float(held.mean())

    def agree(chain: list[Run]) -> float:
        return agreement(chain, slot, values, words)

    bound, best = union(runs), (0.0, 0.0)
    if bound < COVER or not any(r.strong for r in runs):
        return None
    shifts = [r.shift for r in runs]
    for seed in sorted(runs, key=lambda r: r.start - r.end):
        near = runs[bisect_left(shifts, seed.shift - total) : bisect_right(shifts, seed.shift + total)]
        if union(near) < COVER:
            continue
        others = sorted((r for r in near if r is not seed), key=lambda r: r.start - r.end)
        same = [seed, *(r for r in others if r.shift == seed.shift)]
        tried = [same]
        if len(others) >= len(same):
            # with all that fits by place, or only what keeps the slots consistent
            tried += [chained(seed, others, total, lambda c: True), chained(seed, others, total, lambda c: agree(c) >= CONSISTENT)]
        for chain in tried:
            covered = sum(r.end - r.start for r in chain) / total
            if covered >= COVER and (covered, 1.0) > best and any(r.strong for r in chain) and (share := agree(chain)) >= CONSISTENT:
                best = max(best, (covered, share))
        if best >= (bound, 1.0):
            break
    return best if best[0] else None


def judged(pairs: DataFrame) -> DataFrame:
    """``text_key, item_key, covered, consistent`` of the pairs whose matches form a copy."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                words = {}
                for at, held in zip(row.at, row.words):
                    words.update(enumerate(held.split(" "), at))
                runs = runs_of(row.place, row.at - row.place, row.size, row.strong)
                best = best_copy(runs, np.array(row.slots, bool), row.values_, words)
                if best:
                    out.append((row.text_key, row.item_key, *best))
            yield pd.DataFrame(out, columns=["text_key", "item_key", "covered", "consistent"])

    return pairs.mapInPandas(judge, "text_key string, item_key string, covered double, consistent double")


def copies(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """``text_key, item_key, covered, consistent``, one row for each text and item text it holds; stored.

    The keys are the MD5 of the texts; null texts have none.
    """
    small_batches(docs.sparkSession)
    items = benchmark.select(F.md5("text").alias("item_key"), "text").filter("text is not null").dropDuplicates(["item_key"])
    entries = materialize(item_windows(items), "item-windows")
    tokens = materialize(item_tokens(items), "items")
    texts = docs.select(F.md5("text").alias("text_key"), "text").filter("text is not null")
    found = (
        text_windows(texts, entries, block).join(entries, ["hash", "size"])
        # copies of a text give their matches once; tasks combine theirs first
        .groupBy("text_key", "item_key", "place", "at", "size")
        .agg(F.max("strong").alias("strong"), F.min("words").alias("words"), F.min("total").alias("total"))
    )
    pairs = (
        found.groupBy("text_key", "item_key")
        .agg(F.collect_list(F.struct("place", "at", "size", "strong", "words")).alias("hits"), F.max("strong").alias("any_strong"),
             F.sum("size").alias("reach"), F.min("total").alias("total"))
        .filter(F.col("any_strong") & (F.col("reach") >= COVER * F.col("total")))
        .join(tokens, "item_key")
        .select("text_key", "item_key", "slots", F.col("values").alias("values_"),
                *(F.col(f"hits.{name}").alias(name) for name in ("place", "at", "size", "strong", "words")))
    )
    return materialize(judged(pairs), "copies")


def contaminations(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """``doc_id, item_id, covered, consistent``: the items that each whole text holds.

    Null, empty and wordless texts and items hold none and are in none; repeated rows on either
    side each give theirs; ids may be of any type, be null or clash; other columns are ignored;
    without rows on either side there are none.
    """
    found = copies(docs, benchmark, block)
    return (
        docs.select("doc_id", F.md5("text").alias("text_key")).join(found, "text_key")
        .join(benchmark.select("item_id", F.md5("text").alias("item_key")), "item_key")
        .select("doc_id", "item_id", "covered", "consistent")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item; null and empty texts stay."""
    held = copies(docs, benchmark).select(F.col("text_key").alias("__held")).distinct()
    return docs.join(held, F.md5(docs["text"]) == held["__held"], "left_anti")


def op2_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
