"""Ordered fold of listing hits, one sorted range of rows at a time.

A state takes over a hit when the hit *fires*. Which hits fire depends on every hit
before, yet a range of hits can be folded without knowing the state it starts from:
all states that fire at a hit become that hit. What is left is a list of intervals, each
saying "an entry state that fires here ends up there".

Slowly drifting views leave as many intervals as hits, but few ends. So a state that fires
only gets a pointer to the hit it became (followed, and shortened, when the range ends),
heaps tell which states fire, and many intervals share one row: time per hit does not grow
with the range.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark import TaskContext

BASE, FORCED, HIT = 0, 1, 2  # row kinds, in the order they apply at one position
PACKED = 4096  # intervals in one outcome row, at most

ORDER = ["at", "seq", "kind"]
COLUMNS = [
    "platform", "url", *ORDER, "status", "view", "comment_count", "created_at", "checked_at", "blank", "post_id", "words",
]
OUTCOME_SCHEMA = (
    "platform string, url string, part int, n int, role string, "
    "view_low array<bigint>, view_high array<bigint>, count_low array<bigint>, count_high array<bigint>, path array<int>, "
    "states array<struct<view:int,comment_count:int,status:string,created_at:timestamp_ntz,checked_at:timestamp_ntz,"
    "blank_at:timestamp_ntz,blank_seq:bigint>>, "
    "at timestamp_ntz, seq bigint, post_id string, words string"
)
OUTCOME_COLUMNS = [
    "platform", "url", "part", "n", "role", "view_low", "view_high", "count_low", "count_high", "path", "states",
    "at", "seq", "post_id", "words",
]
INTERVALS = ["view_low", "view_high", "count_low", "count_high", "path"]
UNSTABLE = ("FAILED", "BANNED")
NO_TIME = np.iinfo("int64").min  # as a time: not a time
EPOCH = datetime(1970, 1, 1)


class State:
    """Figures of one hit, and the state it became where a later hit fired."""

    __slots__ = ("status", "view", "count", "created", "checked", "blank", "marks", "next")

    def __init__(self, status, view, count, created, checked, blank, marks=0):
        self.status, self.view, self.count, self.created, self.checked = status, view, count, created, checked
        self.blank = blank  # the first empty keyword met, from this hit up to where ``next`` points
        self.marks = marks  # unstable reports of the range before this hit
        self.next = None

    def last(self) -> State:
        """The state this one is by now. Pointers on the way are shortened."""
        way, state = [], self
        while state.next is not None:
            way.append(state)
            state = state.next
        blank = state.blank
        for passed in reversed(way):
            blank = passed.blank = passed.blank or blank
            passed.next = state
        return state


class Run:
    """The rows of one URL inside one sorted range."""

    def __init__(self, key: tuple, part: int, threshold: int, documented: bool):
        self.key, self.part = key, part
        self.threshold, self.documented = threshold, documented
        self.entries = []  # intervals of entry states: [view_low, view_high, count_low, count_high, state]
        self.room = 1024  # intervals before neighbours are merged again
        # open states in order of falling view and count, and of rising ones where those fire too
        self.heaps = [[] for _ in range(4 if documented else 2)]
        self.open = self.pushed = 0
        self.bounds = None
        self.unstable = None  # last (status, checked_at) met by an entry state that never fired
        self.marks = 0
        self.known = None  # the state once it no longer depends on the entry state
        self.from_base = False
        self.words = []  # rows that only carry post_id and keywords along

    def fires(self, state: State, view: int, count: int) -> bool:
        fallen = state.view - view
        if self.documented:
            return abs(fallen) > self.threshold or state.count != count
        return fallen > self.threshold or state.count > count

    def new_extreme(self, view: int, count: int) -> bool:
        """Only a new extreme can be the first hit at which some entry state fires."""
        if self.bounds is None:
            self.bounds = [view, view, count, count]
            return True
        low_view, high_view, low_count, high_count = self.bounds
        self.bounds = [min(low_view, view), max(high_view, view), min(low_count, count), max(high_count, count)]
        lower = view < low_view or count < low_count
        return lower or (self.documented and (view > high_view or count > high_count))

    def add(self, kind: int, status: str, view: int, count: int, created: int, checked: int, blank: bool, at: tuple) -> None:
        if kind != HIT:
            if kind == BASE:
                self.from_base = True
            previous = self.known.blank if self.known else None
            self.known = State(status, view, count, created, checked, previous)
        elif status in UNSTABLE:
            if self.known:
                self.known.status, self.known.checked = status, checked
            else:
                self.unstable = (status, checked)
                self.marks += 1
        elif self.known:
            if self.fires(self.known, view, count):
                self.known = State(status, view, count, created, checked, self.known.blank or (at if blank else None))
        else:
            self.branch(State(status, view, count, created, checked, at if blank else None, self.marks))

    def branch(self, hit: State) -> None:
        """All open states that fire at ``hit`` become it, and entry states that fire first here do."""
        fired = self.fire(hit)
        extreme = self.new_extreme(hit.view, hit.count)
        if not fired and not extreme:
            return
        self.open += 1
        self.pushed += 1
        for heap, key in zip(self.heaps, (-hit.view, -hit.count, hit.view, hit.count)):
            heapq.heappush(heap, (key, self.pushed, hit))
        if extreme:
            self.entries.append([hit.view, hit.view, hit.count, hit.count, hit])
            if len(self.entries) > self.room:
                self.merge_neighbours()

    def fire(self, hit: State) -> bool:
        limits = (-hit.view - self.threshold, -hit.count, hit.view - self.threshold, hit.count)
        fired = False
        for n, (heap, limit) in enumerate(zip(self.heaps, limits)):
            while heap and heap[0][0] < limit:
                state = heapq.heappop(heap)[2]
                if state.next is None:
                    state.next, fired = hit, True
                    self.open -= 1
            if len(heap) > 2 * self.open + 64:  # states that fired by another order
                self.heaps[n] = [item for item in heap if item[2].next is None]
                heapq.heapify(self.heaps[n])
        return fired

    def merge_neighbours(self) -> None:
        """Neighbours that end in one state, and met their first empty keyword at one hit, are one interval."""
        merged, end = [], None
        for entry in self.entries:
            to = entry[4].last()
            if merged and (to, entry[4].blank) == end:
                last = merged[-1]
                last[0], last[1] = min(last[0], entry[0]), max(last[1], entry[1])
                last[2], last[3] = min(last[2], entry[2]), max(last[3], entry[3])
            else:
                merged.append(entry)
                end = (to, entry[4].blank)
        self.entries = merged
        self.room = max(1024, 2 * len(merged))

    def note(self, at: int, seq: int, post_id: str, words: str) -> None:
        self.words.append((*self.key, self.part, 0, "words", *[None] * 6, at, seq, post_id, words))

    def outcomes(self) -> Iterator[tuple]:
        """Rows telling how any entry state leaves this range."""
        yield from self.words
        n = 0
        if not self.from_base:
            self.merge_neighbours()
            for start in range(0, len(self.entries), PACKED):
                yield self.packed(n, self.entries[start : start + PACKED])
                n += 1
            if self.unstable and not self.known:
                status, checked = self.unstable
                yield self.row(n, "unstable", [None] * 5, [self.figures(State(status, None, None, None, checked, None, self.marks))])
                n += 1
        if self.known:
            yield self.row(n, "known", [None] * 5, [self.figures(self.known, self.known.blank, False)])

    def packed(self, n: int, entries: list) -> tuple:
        """Intervals in order, each with the place of its end among ``states``."""
        places, states, path = {}, [], []
        for *_, first in entries:
            end = (first.last(), first.blank)
            if end not in places:
                places[end] = len(states)
                states.append(self.figures(*end))
            path.append(places[end])
        return self.row(n, "entry", [*([entry[i] for entry in entries] for i in range(4)), path], states)

    def figures(self, s: State, blank: tuple | None = None, marked: bool = True) -> dict:
        status, checked = self.unstable if marked and s.marks < self.marks else (s.status, s.checked)
        blank_at, blank_seq = blank or (None, None)
        return {
            "view": s.view, "comment_count": s.count, "status": status, "created_at": moment(s.created),
            "checked_at": moment(checked), "blank_at": moment(blank_at), "blank_seq": blank_seq,
        }

    def row(self, n: int, role: str, intervals: list, states: list) -> tuple:
        return (*self.key, self.part, n, role, *intervals, states, None, None, None, None)


def moment(micros: int | None) -> datetime | None:
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


def micros(times: pd.Series) -> list:
    """Times as whole microseconds, None where missing."""
    values = times.astype("datetime64[us]")
    whole = values.astype("int64").astype(object)
    return whole.where(values.notna(), None).tolist()


def integers(numbers: pd.Series) -> list:
    if numbers.dtype.kind == "i":
        return numbers.tolist()
    return [None if pd.isna(n) else int(n) for n in numbers.tolist()]


def to_frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=OUTCOME_COLUMNS, dtype=object)
    whole = np.array([NO_TIME if t is None else t for t in frame["at"]], dtype="int64")
    frame["at"] = whole.view("datetime64[us]")
    return frame


def fold_ranges(threshold: int, documented: bool):
    """A function for mapInPandas over rows sorted by (platform, url, at, seq, kind)."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, done = None, []
        for batch in batches:
            columns = (
                batch["platform"].tolist(), batch["url"].tolist(), micros(batch["at"]), integers(batch["seq"]),
                batch["kind"].tolist(), batch["status"].tolist(), integers(batch["view"]),
                integers(batch["comment_count"]), micros(batch["created_at"]), micros(batch["checked_at"]),
                batch["blank"].tolist(), batch["post_id"].tolist(), batch["words"].tolist(),
            )
            for platform, url, at, seq, kind, status, view, count, created, checked, blank, post_id, words in zip(*columns):
                if run is None or run.key != (platform, url):
                    if run is not None:
                        done.extend(run.outcomes())
                    run = Run((platform, url), TaskContext.get().partitionId(), threshold, documented)
                run.add(kind, status, view, count, created, checked, blank, (at, seq))
                if kind != HIT:
                    run.note(at, seq, post_id, words)
            if done:
                yield to_frame(done)
                done = []
        if run is not None:
            done.extend(run.outcomes())
        if done:
            yield to_frame(done)

    return fold


CHAIN = ["view", "comment_count", "status", "created_at", "checked_at", "blank_at", "blank_seq"]
FINAL_SCHEMA = (
    "platform string, url string, view int, comment_count int, status string, created_at timestamp_ntz, checked_at timestamp_ntz, "
    "blank_at timestamp_ntz, blank_seq bigint, post_id string"
)


def first_reached(entries: dict, view: int, count: int, threshold: int, documented: bool) -> int | None:
    """The place of the first interval that a state of these figures fires in."""
    hit = (entries["view_low"] < view - threshold) | (entries["count_low"] < count)
    if documented:
        hit |= (entries["view_high"] > view + threshold) | (entries["count_high"] > count)
    at = int(hit.argmax()) if len(hit) else 0
    return at if len(hit) and hit[at] else None


def chain_outcomes(threshold: int, documented: bool):
    """A function for mapInPandas over outcome rows sorted by (platform, url, part, n): each URL's final state.

    One row is looked at at a time and one state is kept, however many ranges a URL was cut into.
    """

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, fired, post_id, done = None, None, False, None, []
        for batch in batches:
            for row in batch.itertuples(index=False):
                if (row.platform, row.url) != key:
                    if key is not None:
                        done.append((*key, *((state or {}).get(name) for name in CHAIN), post_id))
                    key, state, fired, post_id = (row.platform, row.url), None, False, None
                if row.post_id is not None:
                    post_id = row.post_id if post_id is None else max(post_id, row.post_id)
                if row.role == "words":
                    continue
                fired = fired and row.n > 0
                target = None
                if row.role == "known":
                    target = row.states[0]
                elif state is not None and not fired:
                    if row.role == "unstable":
                        sure = row.states[0]
                        state = {**state, "status": sure["status"], "checked_at": sure["checked_at"]}
                    else:
                        entries = {name: np.asarray(getattr(row, name)) for name in INTERVALS[:4]}
                        at = first_reached(entries, state["view"], state["comment_count"], threshold, documented)
                        target = None if at is None else row.states[row.path[at]]
                if target is not None:
                    blank = target if state is None or state["blank_at"] is None else state
                    state = {**{name: target[name] for name in CHAIN[:5]}, "blank_at": blank["blank_at"], "blank_seq": blank["blank_seq"]}
                    fired = fired or row.role == "entry"
            if done:
                yield final_frame(done)
                done = []
        if key is not None:
            yield final_frame([(*key, *((state or {}).get(name) for name in CHAIN), post_id)])

    return chain


def final_frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["platform", "url", *CHAIN, "post_id"], dtype=object)
    for name in ("created_at", "checked_at", "blank_at"):
        frame[name] = pd.to_datetime(frame[name]).astype("datetime64[us]")
    return frame
