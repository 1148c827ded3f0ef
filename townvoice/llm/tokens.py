"""Token counts of every prefix (operator 4).

The vocabulary is a byte-level BPE. A text is cut into pieces by the tokenizer's pattern;
within a piece, dynamic programming finds for each prefix the last token of its encoding:
the one token that ends there, is itself stable, and follows the last token of the rest
without a merge across. Its count is one more than that of the rest. So one pass gives the
exact count of every prefix, and questions on truncation or budgets need no encoding.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 512  # tokens
# the pattern that cuts texts before the merges; fixed value
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED = 400_000  # pieces whose counts a task keeps, and pairs of tokens
CHUNK = 2 << 20  # characters whose counts are sent back at once, about


def byte_of() -> dict[str, int]:
    """The byte each character of a vocabulary file stands for: printable ones themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Prefixes:
    """Counts tokens of all prefixes of a text, under the vocabulary in ``spec`` (JSON)."""

    def __init__(self, spec: str):
        file = json.loads(spec)
        to_byte = byte_of()
        raw = lambda token: bytes(to_byte[c] for c in token)
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in file["model"]["merges"]]
        self.ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        # the merge that makes a token, and its rank
        self.made = {a + b: (rank, a, b) for (a, b), rank in reversed(self.ranks.items())}
        self.edges: tuple[dict[bytes, list], dict[bytes, list]] = ({}, {})
        self.tokens = {raw(token) for token in file["model"]["vocab"] if all(c in to_byte for c in token)}
        self.longest = max(map(len, self.tokens))
        # the first in the text; of two at one place the lesser string, so the shorter of two that begin alike
        special = sorted(token["content"] for token in file["added_tokens"])
        self.specials = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(PATTERN)
        # the same for ASCII texts, which the standard library cuts faster
        self.ascii_pattern = re.compile(PATTERN.replace(r"\p{L}", "A-Za-z").replace(" ?A-Za-z+", " ?[A-Za-z]+").replace(
            r"\p{N}", "0-9").replace(" ?0-9+", " ?[0-9]+"), re.ASCII)
        self.unusual = regex.compile(r"[\u0500-\U0010ffff]")
        self.cutter = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.kinds: dict[str, str] = {}
        self.runs = regex.compile(r"\s{2,}(?=\S)")
        self.stable: dict[bytes, bool | None] = dict.fromkeys(self.tokens)  # None: not looked at yet
        self.fits: dict[bytes, dict[bytes, bool]] = {}
        self.pairs = 0
        self.cache: dict[str, tuple[bytes, int, int]] = {}

    def plain(self, text: str) -> str:
        """``text`` with a sign for each letter that is newer than the library's tables."""
        if text.isascii():
            return text
        unusual = set(self.unusual.findall(text))
        for c in unusual - self.kinds.keys():
            known = len(self.cutter.pre_tokenize_str("a" + c)) == 1 or len(self.cutter.pre_tokenize_str("1" + c)) == 1
            letter = bool(regex.match(r"[\p{L}\p{N}]", c))
            self.kinds[c] = "\u00a7" if letter and not known else c
        newer = {ord(c): self.kinds[c] for c in unusual if self.kinds[c] != c}
        return text.translate(newer) if newer else text

    def merged(self, word: bytes) -> list[bytes]:
        """The tokens of a short word by its merges, lowest rank first."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda pair: self.ranks.get(pair, 1 << 30))
            if best not in self.ranks:
                break
            joined, i = [], 0
            while i < len(parts):
                if tuple(parts[i : i + 2]) == best:
                    joined.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    joined.append(parts[i])
                    i += 1
            parts = joined
        return parts

    def is_stable(self, token: bytes) -> bool:
        found = self.stable[token] = self.merged(token) == [token]
        return found

    def edge(self, token: bytes, side: int) -> list[tuple[int, bytes]]:
        """What stood at one end of a token (0: its left end) before each merge, last merge first, with its rank."""
        found = self.edges[side].get(token)
        if found is None:
            found, at = [], token
            while at in self.made:
                rank, *halves = self.made[at]
                found.append((rank, at))
                at = halves[side]
            found.append((-1, at))
            self.edges[side][token] = found
        return found

    def apart(self, left: bytes, right: bytes) -> bool:
        """Whether no merge joins two tokens across their border.

        Undoes the merges at the border, the last first. Two neighbours that were there
        until rank ``limit`` took them apart would have been joined by a lower one; at an
        equal rank the leftmost pair goes first.
        """
        before, after, ranks = self.edge(left, 1), self.edge(right, 0), self.ranks.get
        i = j = 0
        limit = 1 << 30
        while True:
            rank_a, a = before[i]
            rank_b, b = after[j]
            if ranks((a, b), 1 << 31) < limit:
                return False
            if rank_a > rank_b:
                limit = rank_a
                i += 1
            elif rank_b < 0:
                return True
            else:
                limit = rank_b + 1  # a pair of this rank at the border is further left
                j += 1

    def may_follow(self, left: bytes, right: bytes) -> bool:
        if self.pairs >= CACHED:
            self.fits.clear()
            self.pairs = 0
        self.pairs += 1
        found = self.fits.setdefault(left, {})[right] = self.apart(left, right)
        return found

    def of_bytes(self, piece: bytes) -> list[int]:
        """Tokens of each prefix of an uncut piece, the empty one first.

        One token alone fits at each end, so the likely ones are tried first: the last token
        made longer, or a new one.
        """
        counts, last = [0], [b""]
        stable, fits, longest, none = self.stable.get, self.fits.get, self.longest, {}
        begin = 0
        for end in range(1, len(piece) + 1):
            start, tried = begin, 0
            while True:
                token = piece[start:end]
                good = fits(last[start], none).get(token) if start else stable(token, False)
                if good is None:
                    good = stable(token, False) if start else None
                    if good is None:
                        good = self.is_stable(token)
                    if good and start:
                        good = self.may_follow(last[start], token)
                if good:
                    break
                tried += 1
                start = end - 1 if tried == 1 else max(0, end - longest) if tried == 2 else start + 1
            counts.append(counts[start] + 1)
            last.append(token)
            begin = start
        return counts

    def of_piece(self, piece: str) -> tuple[bytes, int, int]:
        """Tokens after each character of a piece, as packed int32, after the whole, and its length."""
        found = self.cache.get(piece)
        if found is None:
            found = self._of_piece(piece)
            if len(piece) <= 64:
                if len(self.cache) >= CACHED:
                    self.cache.clear()
                self.cache[piece] = found
        return found

    def _of_piece(self, piece: str) -> tuple[bytes, int, int]:
        by_byte = self.of_bytes(piece.encode())
        if piece.isascii():
            counts = by_byte[1:]
        else:
            counts = [by_byte[i] for i in accumulate(len(c.encode()) for c in piece)]
        if piece[0] == "'":  # a cut inside 're leaves the apostrophe and a letter, two pieces
            for i in range(1, len(piece)):
                cut = self.pattern.findall(piece[:i])
                counts[i - 1] = sum(self.of_bytes(part.encode())[-1] for part in cut)
        return array("i", counts).tobytes(), counts[-1], len(piece)

    def ordinary(self, text: str) -> np.ndarray:
        """Tokens of each prefix of a text in which special strings are ordinary."""
        if not text:
            return np.zeros(1, np.int32)
        cut = self.plain(text)
        pieces = (self.ascii_pattern if cut.isascii() else self.pattern).findall(cut)
        if cut != text:
            ends = np.cumsum([len(piece) for piece in pieces])
            pieces = [text[end - len(piece) : end] for piece, end in zip(pieces, ends)]
        known = self.cache.get
        inside, totals, lengths = zip(*[known(piece) or self.of_piece(piece) for piece in pieces])
        totals = np.array(totals, np.int32)
        before = np.cumsum(totals, dtype=np.int32) - totals
        counts = np.frombuffer(b"".join(inside), np.int32) + np.repeat(before, lengths)
        counts = np.concatenate([np.zeros(1, np.int32), counts])
        for run in self.runs.finditer(text):  # white space at the end of a prefix is one piece
            counts[run.end()] = counts[run.start()] + self.of_piece(run.group())[1]
        return counts

    def counts(self, text: str) -> np.ndarray:
        """Tokens of ``text[:i]`` for i = 0 ... len(text)."""
        found, start, before = [], 0, 0
        for special in self.specials.finditer(text) if self.specials else ():
            at, end = special.span()
            head = self.ordinary(text[start : end - 1])  # a cut inside the string is ordinary
            found.append(head + np.int32(before))
            before += int(head[at - start]) + 1
            start = end
        rest = self.ordinary(text[start:])
        return np.concatenate([*found, rest + np.int32(before)]) if found else rest


def prefix_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_bytes, prefix_tokens``: element i + 1 is the count of the first i characters.

    The last element is the count of the whole text, as the library gives it without added
    tokens. Null counts as the empty text, whose only prefix has 0 tokens; repeated rows are
    counted alike; other columns are ignored; no rows give no rows. The file is read on the
    driver and travels with the tasks; a Python worker keeps its tables for its next tasks.
    """
    small_batches(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast({"spec": file.read()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value  # one object for all tasks of a worker
        if "prefixes" not in own:
            own["prefixes"] = Prefixes(own["spec"])
        prefixes = own["prefixes"]
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            arrays, start, held = [], 0, 0
            for i, text in enumerate(texts):
                arrays.append(prefixes.counts(text.as_py() or ""))
                held += len(arrays[-1])
                if held >= CHUNK or i + 1 == len(texts):
                    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays)))
                    yield pa.RecordBatch.from_arrays([ids.slice(start, i + 1 - start), lists], names=["doc_id", "prefix_tokens"])
                    arrays, start, held = [], i + 1, 0

    kind = docs.schema["doc_id"].dataType.simpleString()
    sized = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = F.octet_length("text").cast("long").alias("n_bytes")
    counted = sized.select(F.struct("doc_id", size).alias("doc_id"), "text").mapInArrow(
        count, f"doc_id struct<doc_id: {kind}, n_bytes: bigint>, prefix_tokens array<int>")
    return counted.select("doc_id.doc_id", "doc_id.n_bytes", "prefix_tokens")


def total(prefixes: Column) -> Column:
    """Tokens of the whole text."""
    return F.element_at(prefixes, -1).cast("long")


def fitting(prefixes: Column, budget: int) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens; 0 for a negative budget."""
    fits = F.array_position(F.reverse(F.transform(prefixes, lambda n: n <= budget)), True)
    return F.when(fits > 0, F.size(prefixes) - fits).otherwise(0).cast("long")


def op4_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = prefix_tokens(table(spark, sf_dir, "documents"))
    n_tokens = total(F.col("prefix_tokens"))
    return counted.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > LIMIT).alias("over_limit"))
