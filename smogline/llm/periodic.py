"""Periodic runs (12): stretches of words that repeat with a period, by a suffix automaton with link-cut access.

The suffix links of a text's automaton form a tree; the path from the state of a
prefix to the root holds all suffixes of that prefix. Words are appended one by
one. Each appended word's path is accessed: the link-cut tree keeps the states
whose latest occurrence ended at the same word together in one splay tree, so
an access meets few segments (logarithmic, amortised) and recolours them with
the new end. A segment of string lengths (low, high] that was last seen q words
earlier yields a square of period q if low < q <= high, with a primitive root,
and every such square shows up so. Then the text has period q over the last
high + q words; squares of one start and period grow into one run.

Only candidate stretches are walked. A run of period q repeats each of its words
q words later, at least 3 q times in a row, so positions are candidates if
words equal those q before (q < 8), or groups of eight words recur within less
than twice a power of two, for that many positions in a row. This can only keep
too much, never too little.

A row is worked on by itself: there is no shuffle, and copies, hot keys and lost
executors do not matter. Memory is that of the batch's texts and of the
automaton of the longest candidate stretch.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from smogline.llm.common import texts

#: Words whose repeats are looked at together. Longer texts are looked at alone.
TOGETHER = 50_000
#: Periods below this are looked for directly; longer ones by groups of as many words.
GROUP = 8


def automaton(word_ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton of a text: length of each state's longest string, suffix links, state of each prefix."""
    longest, link, moves, ends = [0], [-1], [{}], []
    last = 0
    for word in word_ids:
        now = len(longest)
        longest.append(longest[last] + 1)
        link.append(0)
        moves.append({})
        at = last
        while at >= 0 and word not in moves[at]:
            moves[at][word] = now
            at = link[at]
        if at >= 0:
            to = moves[at][word]
            if longest[to] == longest[at] + 1:
                link[now] = to
            else:
                twin = len(longest)
                longest.append(longest[at] + 1)
                link.append(link[to])
                moves.append(moves[to].copy())
                link[to] = link[now] = twin
                while at >= 0 and moves[at].get(word) == to:
                    moves[at][word] = twin
                    at = link[at]
        ends.append(now)
        last = now
    return longest, link, ends


class LastEnds:
    """Link-cut tree over the suffix links; each preferred path is coloured with the latest end of its strings.

    Node 0 stands for none, state s is node s + 1. Shallower nodes are to the
    left. The colour of a path is kept at the root of its splay tree.
    """

    def __init__(self, longest: list[int], link: list[int]):
        self.longest = [0, *longest]
        self.up = [0] + [s + 1 for s in link]
        self.left, self.right = [0] * len(self.up), [0] * len(self.up)
        self.end = [-1] * len(self.up)

    def _turn(self, x: int) -> None:
        """Rotate a node over its parent."""
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner:
            up[inner] = p
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x
        up[p], up[x] = x, g

    def _splay(self, x: int) -> None:
        up, left, right, end = self.up, self.left, self.right, self.end
        while p := up[x]:
            x_left = left[p] == x
            if not x_left and right[p] != x:
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self._turn(p if x_left == (left[g] == p) else x)
                self._turn(x)
                end[x] = end[g]  # right if g was the root; else set again further up
            else:
                self._turn(x)
                end[x] = end[p]
                return

    def access(self, state: int, at: int) -> list[tuple[int, int]]:
        """Colour the path of a state with the end ``at``; (length, earlier end) of the segments it had, deepest first."""
        up, right, end, longest = self.up, self.right, self.end, self.longest
        segments = []
        x, below = state + 1, 0
        while x:
            self._splay(x)
            segments.append((longest[x], end[x]))
            if right[x]:
                end[right[x]] = end[x]
            right[x] = below
            below, x = x, up[x]
        end[below] = at
        return segments


def runs_of(word_ids: list[int], least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs of at least ``least`` words and ``times`` periods, by start and period."""
    longest, link, ends = automaton(word_ids)
    tree = LastEnds(longest, link)
    last: dict[tuple[int, int], int] = {}
    for at, state in enumerate(ends):
        high = period = 0
        for length, earlier in [*tree.access(state, at), (0, -1)]:
            if length < period <= high and high >= (times - 1) * period and high + period >= least:
                last[at - high - period + 1, period] = at
            high, period = length, at - earlier if earlier >= 0 else 0
    return sorted((start, end - start + 1, period) for (start, period), end in last.items())


def _stretches(flags: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """(first, behind last) of each stretch of at least ``least`` true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    long = edges[1::2] - edges[::2] >= least
    return zip(edges[::2][long].tolist(), edges[1::2][long].tolist())


def candidates(ids: np.ndarray, document: np.ndarray, least: int = 6, times: int = 4) -> list[tuple[int, int]]:
    """Stretches (first, behind last), apart from each other, that hold all runs of ``times`` periods.

    ids: words of several documents in a row, all different between two
    documents. A word more is taken on each side, and stretches that meet are
    one, so that a run is never cut.
    """
    n, found = len(ids), []
    for period in range(1, min(GROUP, n)):
        same = ids[period:] == ids[:-period]
        for first, behind in _stretches(same, max(least - period, (times - 1) * period)):
            found.append((first, behind + period))
    if n > GROUP:
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        groups = document[: n - GROUP + 1].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(GROUP):  # equal groups have equal sums; a chance equality only adds candidates
            groups += mixed[k : n - GROUP + 1 + k] * np.uint64(2 * (0x632BE59BD9B4E019 >> k) + 1)
        order = np.argsort(groups, kind="stable")
        far = np.iinfo(np.int64).max
        back = np.full(len(groups), far)
        again = groups[order[1:]] == groups[order[:-1]]
        back[order[1:][again]] = (order[1:] - order[:-1])[again]
        for first, behind in _stretches(back < far, (times - 1) * GROUP - GROUP + 1):
            part, scale = back[first:behind], GROUP
            while (times - 1) * scale - GROUP + 1 <= len(part):
                for a, b in _stretches(part < 2 * scale, (times - 1) * scale - GROUP + 1):
                    found.append((first + a - 2 * scale, first + b + GROUP))
                scale *= 2
    merged: list[list[int]] = []
    for first, behind in sorted((max(0, a - 1), min(n, b + 1)) for a, b in found):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], behind)
        else:
            merged.append([first, behind])
    return [(a, b) for a, b in merged]


def runs_of_all(documents: list[np.ndarray], least: int = 6, times: int = 4) -> list[list[tuple[int, int, int]]]:
    """Runs of each document, given its words as numbers from 0."""
    if times < 3:
        raise ValueError("candidates are those of runs of three periods or more")
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    sizes = [len(d) for d in documents]
    starts = np.cumsum([0] + [n + 1 for n in sizes])
    ids = np.empty(int(starts[-1]), np.int64)
    number = np.repeat(np.arange(len(documents)), [n + 1 for n in sizes])
    for k, words in enumerate(documents):
        ids[starts[k] : starts[k] + sizes[k]] = words
        ids[starts[k] + sizes[k]] = -2 - k  # parts two documents
    for first, behind in candidates(ids, number, least, times):
        low, high = number[first], number[behind - 1]
        for k in range(int(low), int(high) + 1):  # one, but for the words taken at the sides
            a, b = max(first, int(starts[k])), min(behind, int(starts[k]) + sizes[k])
            if b - a >= least:
                at = a - int(starts[k])
                out[k] += [(start + at, length, period) for start, length, period in runs_of(ids[a:b].tolist(), least, times)]
    return [sorted(r) for r in out]


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Original word number at each place of a document whose end is to repeat, else None; without an id none does."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return np.concatenate([np.arange(a), a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))])


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Flags of the words that are in no run behind its first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) == 0


def _analysed(batch: pd.DataFrame, plant: bool, least: int, times: int) -> Iterator[tuple[object, list[bytes], list[tuple[int, int, int]]]]:
    """(id, words, runs) of each row, some documents at a time."""
    some: list[tuple[object, list[bytes], np.ndarray]] = []
    number: defaultdict[bytes, int] = defaultdict(count().__next__)

    def done():
        found = runs_of_all([ids for _, _, ids in some], least, times)
        return [(doc_id, words, runs) for (doc_id, words, _), runs in zip(some, found)]

    size = 0
    for doc_id, text in zip(batch["doc_id"], batch["text"]):
        doc_id = None if pd.isna(doc_id) else int(doc_id)
        words = text.encode("utf-8", "replace").split()  # bytes part at the six blanks only
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        if plant and (moved := planted(doc_id, len(words))) is not None:
            words, ids = [words[k] for k in moved.tolist()], ids[moved]
        if some and size + len(words) > TOGETHER:
            yield from done()
            some, size = [], 0
            number = defaultdict(count().__next__)
            ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        some.append((doc_id, words, ids))
        size += len(words)
    if some:
        yield from done()


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``period`` (in words) of every run of every text.

    A missing or empty text has no run; repeated rows have theirs each; other
    columns are not read; an empty table gives an empty table.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, *run) for i, _, runs in _analysed(batch, False, least, times) for run in runs]
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "period"])
            yield out.astype({"doc_id": "Int64", "start": "int64", "length": "int64", "period": "int64"})

    return texts(docs).mapInPandas(find, "doc_id long, start long, length long, period long")


def collapse_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """``doc_id``, ``text``: every run reduced to its first period, words joined by one space.

    A text without runs stays as it is, blanks included; a missing one is empty.
    """

    def collapse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for (_, words, runs), text in zip(_analysed(batch, False, least, times), batch["text"]):
                if runs:
                    keep = np.flatnonzero(_kept(len(words), runs)).tolist()
                    text = b" ".join([words[k] for k in keep]).decode("utf-8")
                found.append(text)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text": found})

    return texts(docs).mapInPandas(collapse, "doc_id long, text string")


DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, n_words long, n_kept long"
)


def run_digest(docs: DataFrame) -> DataFrame:
    """Number of runs, the run of most periods and checksums per document, with repeating ends planted in a tenth.

    Exponents are compared exactly; of equal ones the smallest start, then the
    smallest period counts. ``n_words`` and ``n_kept`` count words with and
    without repeats. A missing or empty text has 0 words; a row without id gets
    no planted end; repeated rows appear each; an empty table gives none.
    """

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, words, runs in _analysed(batch, True, 6, 4):
                kept, best = words, (None, None, None, None)
                if runs:
                    kept = [words[k] for k in np.flatnonzero(_kept(len(words), runs)).tolist()]
                    top = runs[0]
                    for run in runs[1:]:  # in order, so that ties go to the first
                        if run[1] * top[2] > top[1] * run[2]:
                            top = run
                    best = (*top, 1000 * top[1] // top[2])
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                sums = (hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())
                rows.append((doc_id, len(runs), *best, *sums, len(words), len(kept)))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in DIGEST.split(", ")])
            nullable = ("doc_id", "start", "length", "period", "exponent_milli")
            yield out.astype({c: "Int64" for c in nullable})

    return texts(docs).mapInPandas(digest, DIGEST)
