"""Packing (2): documents into sequences of a fixed length, as a cutting-stock problem.

Lengths are counted in a histogram of classes. A linear program over patterns
(how many pieces of each class one sequence takes) is solved by column
generation: a knapsack dynamic program prices the best new pattern against the
dual prices until none pays. Patterns are rounded down, what is left is packed
largest first, and the pieces, ranked within their class, take the places.

The driver sees the histogram (at most ``capacity / unit`` counts) and the
patterns; pieces stay distributed.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.common import texts
from smogline.session import stage

#: Words whose ids a Python worker remembers, some 100 MB.
REMEMBERED = 700_000
#: Documents encoded together.
TOGETHER = 256
#: Pieces that are ranked together in one task, on average.
RANKED = 200_000

#: ASCII marks that end a word; the bar is kept for parting words.
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{}~"
#: First bytes of the letters from U+00C0 to U+017F, and the two signs among them.
LATIN, SIGNS = (b"\xc3", b"\xc4", b"\xc5"), (b"\xc3\x97", b"\xc3\xb7")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Words(dict):
    """Words by number, in the order in which they came; the ids of all lie in one array."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []  # numbered, but without ids yet
        self.start, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.ids, self.used = np.zeros(1024, "<u4"), 0

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def forget(self, kept: int) -> None:
        """Keep the words that came first; frequent ones are among them."""
        words = list(islice(self, kept))
        self.clear()
        self.update(zip(words, range(kept)))
        self.used = int((self.start[:kept] + self.length[:kept]).max(initial=0))

    def give(self, numbers: np.ndarray, ids: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
        """Add ids to the array; each word's own start there, counted from the first one added."""
        size = 1 << max(len(self), 1024).bit_length()
        if size > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros(size - len(x), x.dtype)]) for x in (self.start, self.length))
        end = self.used + len(ids)
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros((1 << end.bit_length()) - len(self.ids), "<u4")])
        self.ids[self.used : end] = ids
        self.start[numbers], self.length[numbers] = start + self.used, length
        self.used = end

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words in a row, and where those of each word end."""
        length = self.length[numbers]
        ends = np.cumsum(length, dtype=np.int64)
        at = np.repeat(self.start[numbers] - ends + length, length)
        at += np.arange(len(at))
        return self.ids[at], ends


@lru_cache(1)
def _words(path: str) -> Words:
    return Words()


def forget_words() -> None:
    """Free what this worker keeps for encoding; workers live on, and other operators need the room."""
    _words.cache_clear()
    _tokenizer.cache_clear()


class Encoder:
    """Ids of whole texts as bytes (little-endian, 4 per id).

    The tokenizer drops blanks and never joins what they part, so a text's ids
    are those of its words in a row, and each distinct word is encoded once. A
    text that may hold special tokens is encoded as a whole.
    """

    def __init__(self, path: str):
        self.tokenizer, self.known = _tokenizer(path), _words(path)
        [self.bar] = self.tokenizer.encode("|", add_special_tokens=False).ids

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def learn(self) -> None:
        """Give ids to the new words."""
        known, bare, tailed = self.known, [], []
        # marks after a letter or digit are a token apart from it; only letters that no normalisation takes apart count
        for w in known.new:  # heads and tails that are new join the end of this list
            head = w.rstrip(MARKS)
            last = head[-1:]
            if head and head is not w and (last.isalnum() or (head[-2:-1] in LATIN and head[-2:] not in SIGNS)):
                tailed.append((known[w], known[head], known[w[len(head) :]]))
            elif b"|" in w:
                ids = self.whole(w.decode("utf-8", "replace"))
                known.give(np.array([known[w]]), ids, np.zeros(1, np.int64), np.array([len(ids)]))
            else:
                bare.append(w)
        for start in range(0, len(bare), 1024):  # many words in one call, bars between them
            some = bare[start : start + 1024]
            text = b" | ".join(some).decode("utf-8", "replace")
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.bar)
            begin = np.concatenate([[0], cuts + 1])
            numbers = np.fromiter(map(known.__getitem__, some), np.int64, len(some))
            known.give(numbers, ids, begin, np.append(cuts, len(ids)) - begin)
        if tailed:
            numbers, heads, tails = np.array(tailed, np.int64).T
            ids, ends = known.ids_of(np.column_stack([heads, tails]).ravel())
            length = known.length[heads] + known.length[tails]
            known.give(numbers, ids, ends[1::2] - length, length)
        known.new = []

    def encode(self, batch: list[str]) -> list[bytes]:
        known = self.known
        if known.new:  # an earlier task of this worker ended between numbers and ids
            known.new = []
            known.forget(0)
        elif len(known) > REMEMBERED:
            known.forget(REMEMBERED // 2)
        plain = [None if "<|" in t else t.encode("utf-8", "replace").lower().split() for t in batch]
        sizes = [len(words or ()) for words in plain]
        number = known.__getitem__
        numbers = np.fromiter(chain.from_iterable(map(number, words) for words in plain if words), np.int64, sum(sizes))
        self.learn()
        ids, ends = known.ids_of(numbers)
        ends = np.concatenate([[0], ends])[np.cumsum([0, *sizes])]
        parts = map(slice, ends[:-1].tolist(), ends[1:].tolist())
        return [(self.whole(t) if words is None else ids[part]).tobytes() for t, words, part in zip(batch, plain, parts)]


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """Documents as ids and an end id, cut after every ``capacity`` ids.

    A missing or empty text is the end id alone; a repeated row is a document
    of its own; only ``doc_id`` and ``text`` are read.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = Encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids, all_texts = batch["doc_id"].to_list(), batch["text"].to_list()
            for at in range(0, len(batch), TOGETHER):
                rows = []
                for doc_id, ids in zip(doc_ids[at : at + TOGETHER], encoder.encode(all_texts[at : at + TOGETHER])):
                    ids += end
                    n = len(ids) // 4
                    for s in range(0, n, capacity):
                        piece = ids[4 * s : 4 * (s + capacity)]
                        rows.append((doc_id, s, len(piece) // 4, zlib.crc32(piece), n))
                out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return texts(docs).mapInPandas(cut, PIECES)


def knapsack(prices: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable pattern of at most ``capacity``, by dynamic programming; widths ascend."""
    price, number = np.full(capacity + 1, -np.inf), np.full(capacity + 1, -1)
    price[widths], number[widths] = prices, np.arange(len(widths))
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        values = best[c - 1 :: -1] + price[1 : c + 1] if c > 1 else best[:1] + price[1:2]
        k = int(values.argmax())  # a last piece of width k + 1
        if values[k] > best[c - 1] + 1e-12:
            best[c], last[c] = values[k], number[k + 1]
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(len(widths), dtype=np.int64), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= int(widths[last[c]])
    return float(best[capacity]), pattern


def inverted(matrix: np.ndarray) -> np.ndarray:
    """Inverse by elimination; the matrices are small, and no library threads start on the driver."""
    m = len(matrix)
    both = np.hstack([matrix, np.eye(m)])
    for k in range(m):
        pivot = k + int(np.abs(both[k:, k]).argmax())
        both[[k, pivot]] = both[[pivot, k]]
        both[k] /= both[k, k]
        factors = both[:, k].copy()
        factors[k] = 0
        both -= np.outer(factors, both[k])
    return both[:, m:]


def patterns(widths: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns with their number of sequences; they take every piece exactly once.

    Column generation with a revised simplex. Every basis is a feasible plan,
    so a stop at the iteration limit costs padding, never pieces.
    """
    if not widths:
        return []
    w, need = np.array(widths, dtype=np.int64), np.array(demand, dtype=np.int64)
    m = len(w)
    basis = np.diag(capacity // w).astype(float)
    inverse, x = np.diag(1.0 / np.diag(basis)), need / np.diag(basis)
    bound = 0.0
    for step in range(40 * m):
        value, pattern = knapsack(np.maximum(inverse.sum(axis=0), 0), w, capacity)
        bound = max(bound, float(x.sum()) / value)  # no plan is shorter (Farley)
        if x.sum() - bound <= 0.3 + 0.0005 * bound:
            break
        d = (inverse * pattern).sum(axis=1)
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = pattern
        if step % 64 == 63:
            inverse = inverted(basis)
            x = np.maximum((inverse * need).sum(axis=1), 0)
        else:
            x = np.maximum(x - ratio[out] * d, 0)
            x[out] = ratio[out]
            row = inverse[out] / d[out]
            inverse -= np.outer(d, row)
            inverse[out] = row
    plan, left = [], need.copy()
    for k in np.argsort(-x):
        pattern = basis[:, k].round().astype(np.int64)
        taken = pattern > 0
        times = min(int(x[k] + 1e-6), int((left[taken] // pattern[taken]).min()))
        if times:
            plan.append((pattern, times))
            left -= times * pattern
    while left.any():
        pattern, room = np.zeros(m, dtype=np.int64), capacity
        for k in range(m - 1, -1, -1):
            pattern[k] = min(left[k], room // w[k])
            room -= pattern[k] * w[k]
        taken = pattern > 0
        times = int((left[taken] // pattern[taken]).min())
        plan.append((pattern, times))
        left -= times * pattern
    return plan


def runs_of(widths: list[int], plan: list[tuple[np.ndarray, int]]) -> dict[int, np.ndarray]:
    """Per class the ranks from which a pattern takes its pieces: columns rank, first sequence, pieces each."""
    runs: dict[int, list[tuple[int, int, int]]] = {w: [] for w in widths}
    at, sequence = dict.fromkeys(widths, 0), 0
    for pattern, times in plan:
        for w, n in zip(widths, pattern):
            if n:
                runs[w].append((at[w], sequence, int(n)))
                at[w] += int(n) * times
        sequence += times
    return {w: np.array(r, dtype=np.int64) for w, r in runs.items()}


def pack(pieces: DataFrame, capacity: int = 2048, unit: int = 8) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` ids.

    Pieces of a class are ranked in two levels, so that a class with a third of
    all pieces is ranked by many tasks. Pieces are told apart by a number that
    is written with them, so repeated ids spread like others and a repeated
    task ranks alike. An empty table gives an empty table.
    """
    columns, number = pieces.columns, "piece"
    while number in columns:
        number += "_"
    pieces = stage(pieces.withColumn(number, F.monotonically_increasing_id()), "pieces")
    width = F.ceil(F.col("length") / F.lit(unit)).cast("long")
    histogram = sorted((r["width"], r["n"]) for r in pieces.groupBy(width.alias("width")).agg(F.count("*").alias("n")).collect())
    widths, demand = [w for w, _ in histogram], [n for _, n in histogram]
    runs = runs_of(widths, patterns(widths, demand, capacity // unit))

    salts = sum(demand) // RANKED + 1
    salted = pieces.withColumns({"width": width, "salt": F.pmod(F.xxhash64(number), F.lit(salts))})
    before = Window.partitionBy("width").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy("width", "salt").agg(F.count("*").alias("n"))
    counts = counts.select("width", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = Window.partitionBy("width", "salt").orderBy(number)
    ranked = (
        salted.withColumn("place", F.row_number().over(place))
        .join(counts, ["width", "salt"])
        .withColumn("rank", F.col("before") + F.col("place") - 1)
        .drop("salt", "place", "before")
    )

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_words()  # the pieces are written, so all texts are encoded
        for batch in batches:
            rank, width = batch["rank"].to_numpy(), batch["width"].to_numpy()
            sequence = np.zeros(len(batch), dtype=np.int64)
            for w in np.unique(width):
                here, run = width == w, runs[int(w)]
                r = rank[here]
                k = np.searchsorted(run[:, 0], r, "right") - 1
                sequence[here] = run[k, 1] + (r - run[k, 0]) // run[k, 2]
            yield batch.drop(columns=["rank", "width"]).assign(sequence_id=sequence)

    fields = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    placed = ranked.select(*pieces.columns, "width", "rank").mapInPandas(assign, f"{fields}, sequence_id long")
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", number)
    so_far = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("offset", so_far - F.col("length")).select(*columns, "sequence_id", "offset")
