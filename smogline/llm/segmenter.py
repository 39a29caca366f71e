"""SentencePiece encoding and decoding (1) with sampled segmentations.

The pieces that match a text form a lattice. Forward filtering sums the weights
of all segmentations up to each character; backward sampling then draws one
segmentation exactly by its weight, from random numbers that depend on the row
key only. No piece holds a space or line feed after another character, so the
lattice of a text is a chain of independent lattices of its units, and each
distinct unit is filtered once.

Characters that are no piece become bytes, and so does a literal U+2581, which
pieces use for the space: decoding gives back every text.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from smogline.llm.common import texts
from smogline.llm.shingles import mix

UNIT = re.compile(r"\n| *[^ \n]+| +")
#: Lattice nodes that a worker keeps before it drops the newer half; frequent units came first.
NODES = 2_400_000
#: Weight of a character that is no piece, as bytes.
AS_BYTES = 1e-9
#: Characters sampled at once.
AT_ONCE = 400_000


class Pieces:
    """Pieces of a model: text to id, weights, bytes."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.first_byte = model.piece_to_id("<0x00>")
        self.ids, self.weight, self.bytes = {}, {}, [b""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace("▁", " ")
                if " " in text.lstrip(" ") or "\n" in text:
                    raise ValueError(f"piece {i} spans units")
                self.bytes[i] = text.encode()
                self.ids[text] = i
                # merges are ranked by use: a Zipf law over ranks, made flatter or steeper by alpha
                self.weight[text] = (1.0 / (i + 10)) ** alpha
        self.longest = max(map(len, self.ids))
        # a state per beginning of a piece; moves are (state, next character) in order
        starts = sorted({t[:k] for t in self.ids for k in range(1, len(t) + 1)})
        state = {"": 0} | {t: k + 1 for k, t in enumerate(starts)}
        moves = np.array([state[t[:-1]] << 21 | ord(t[-1]) for t in starts], dtype=np.int64)
        # open addressing: a move stands in the first free slot from its hash on; -1 is free
        self.shift = np.uint64(64 - (4 * len(moves)).bit_length())
        self.moves, self.to = np.full(1 << (64 - int(self.shift)), -1), np.zeros(1 << (64 - int(self.shift)), dtype=np.int64)
        left, slot = np.arange(len(moves)), self.slot(moves)
        while len(left):
            free = self.moves[slot] < 0
            self.moves[slot[free]] = moves[left[free]]  # one of those that want the slot gets it
            placed = self.moves[slot] == moves[left]
            self.to[slot[placed]] = left[placed] + 1
            left, slot = left[~placed], (slot[~placed] + 1) & (len(self.moves) - 1)
        self.id_of = np.array([-1, *[self.ids.get(t, -1) for t in starts]], dtype=np.int64)
        self.weight_of = np.array([0.0, *[self.weight.get(t, 0.0) for t in starts]])

    def slot(self, moves: np.ndarray) -> np.ndarray:
        return ((moves.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def edges(self, codes: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last character, id and weight of every piece in units put in a row, and of characters that are none.

        ``stop`` is the end of each character's unit.
        """
        at, state = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64)
        found, alone = [], np.zeros(len(codes), dtype=bool)
        for step in range(self.longest):
            key = state << 21 | codes[at + step]
            k = self.slot(key)
            on = np.flatnonzero((self.moves[k] != key) & (self.moves[k] >= 0))
            while len(on):  # taken by another move
                k[on] = (k[on] + 1) & (len(self.moves) - 1)
                on = on[(self.moves[k[on]] != key[on]) & (self.moves[k[on]] >= 0)]
            hit = self.moves[k] == key
            at, state = at[hit], self.to[k[hit]]
            is_piece = self.id_of[state] >= 0
            first = at[is_piece]
            found.append((first, first + step, self.id_of[state[is_piece]], self.weight_of[state[is_piece]]))
            if step == 0:
                alone[first] = True
            on = at + step + 1 < stop[at]
            at, state = at[on], state[on]
            if not len(at):
                break
        rest = np.flatnonzero(~alone)
        found.append((rest, rest, -codes[rest] - 1, np.full(len(rest), AS_BYTES)))
        return tuple(np.concatenate(x) for x in zip(*found))


@lru_cache(2)
def pieces_of(path: str, alpha: float) -> Pieces:
    return Pieces(path, alpha)


class Sampler:
    """Forward-filtered lattices of units, and backward sampling over many units at once.

    A node is the end of a character in its unit. ``first`` has its first edge,
    the last edge before the next node's; an edge has its piece, the node
    before the piece (-1: none) and the probability of the node's edges up to it.
    """

    def __init__(self, path: str, alpha: float = 1.0, seed: int = 42):
        self.pieces, self.seed = pieces_of(path, alpha), seed
        self.unit: dict[str, int] = {}  # its last node
        self.first, self.back, self.piece, self.cum = array("i"), array("i"), array("i"), array("d")
        self.marks: list[tuple[int, int]] = []  # nodes and edges after each time units were learnt

    def shrink(self, nodes: int) -> None:
        """Keep that many of the oldest nodes at most; what was learnt at once stays or goes as a whole."""
        self.marks = [m for m in self.marks if m[0] <= nodes]
        nodes, edges = self.marks[-1] if self.marks else (0, 0)
        self.unit = {u: k for u, k in self.unit.items() if k < nodes}
        del self.first[nodes:], self.back[edges:], self.piece[edges:], self.cum[edges:]

    def learn(self, units: list[str]) -> None:
        """Filter the lattices of new units, all at once by the characters' places in them."""
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.array([len(u) for u in units], dtype=np.int64)
        begin, n = np.cumsum(sizes) - sizes, len(codes)
        place = np.arange(n) - np.repeat(begin, sizes)
        first_char, last_char, piece, weight = self.pieces.edges(codes, np.repeat(begin + sizes, sizes))
        # nodes by place, then unit: what a node needs comes before it
        node = np.empty(n, dtype=np.int64)
        node[np.argsort(place, kind="stable")] = np.arange(n)
        into = node[last_char]
        order = np.argsort(into * (self.pieces.longest + 1) + last_char - first_char)
        into, piece, weight, first_char = into[order], piece[order], weight[order], first_char[order]
        back = np.where(place[first_char] > 0, node[first_char - 1], -1)
        counts = np.bincount(into, minlength=n)  # at least one each
        first = np.cumsum(counts) - counts
        # sums of weights as mantissa and exponent; -1 is where a unit begins
        mantissa, exponent = np.full(n + 1, 0.5), np.ones(n + 1, dtype=np.int64)
        share = np.empty(len(into))
        ends = np.cumsum(np.bincount(place))
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
            lo, hi = first[a], first[b] if b < n else len(into)
            here, many, e = first[a:b] - lo, counts[a:b], exponent[back[lo:hi]]
            top = np.maximum.reduceat(e, here)
            w = np.ldexp(mantissa[back[lo:hi]] * weight[lo:hi], e - np.repeat(top, many))
            total = np.add.reduceat(w, here)
            share[lo:hi] = w / np.repeat(total, many)
            mantissa[a:b], more = np.frexp(total)
            exponent[a:b] = top + more
        for rank in range(1, int(counts.max())):
            edge = first[counts > rank] + rank
            share[edge] += share[edge - 1]
        share[first + counts - 1] = 2.0  # the last edge takes what rounding leaves
        nodes, edges = len(self.first), len(self.cum)
        self.first.frombytes((first + edges).astype(np.int32).tobytes())
        self.back.frombytes(np.where(back < 0, -1, back + nodes).astype(np.int32).tobytes())
        self.piece.frombytes(piece.astype(np.int32).tobytes())
        self.cum.frombytes(share.tobytes())
        self.unit.update(zip(units, (node[begin + sizes - 1] + nodes).tolist()))
        self.marks.append((len(self.first), len(self.cum)))

    def sample(self, batch: list[str], keys: list[int]) -> list[np.ndarray]:
        """Ids per text. A space is put before a text that is not empty; decoding takes it away."""
        if len(self.first) > NODES:
            self.shrink(NODES // 2)
        units = [UNIT.findall(" " + t) if t else [] for t in batch]
        every = list(chain.from_iterable(units))
        if new := set(every).difference(self.unit):
            self.learn(list(new))
        # views without a copy, gone before the next units are learnt
        first, back, piece = (np.frombuffer(x, np.int32) for x in (self.first, self.back, self.piece))
        cum = np.frombuffer(self.cum, np.float64)
        counts = np.array([len(u) for u in units], dtype=np.int64)
        node = np.fromiter(map(self.unit.__getitem__, every), dtype=np.int64, count=len(every))
        start = np.repeat(np.cumsum(counts) - counts, counts)
        seeds = mix(np.array(keys, dtype=np.int64).view(np.uint64) + np.uint64(self.seed))
        state = mix(np.repeat(seeds, counts) + (np.arange(len(node)) - start).astype(np.uint64))
        active, steps = np.arange(len(node)), np.zeros(len(node), dtype=np.int64)
        drawn = []
        while len(active):
            u = (mix(state[active] + steps[active].astype(np.uint64)) >> np.uint64(11)) * 2.0**-53
            edge = first[node[active]].astype(np.int64)
            beyond = np.flatnonzero(cum[edge] <= u)
            while len(beyond):
                edge[beyond] += 1
                beyond = beyond[cum[edge[beyond]] <= u[beyond]]
            drawn.append((active, piece[edge]))
            steps[active] += 1
            before = back[edge]
            node[active] = before
            active = active[before >= 0]
        ends = np.cumsum(steps)
        out = np.zeros(int(steps.sum()), dtype=np.int64)
        for step, (which, found) in enumerate(drawn):
            out[ends[which] - 1 - step] = found
        out, added = self.expand(out)
        cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        cut += np.concatenate([[0], np.cumsum(added)])[cut]
        out = out.astype("<u4")
        return [out[a:b] for a, b in zip(cut[:-1], cut[1:])]

    def expand(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte ids in place of characters that are no piece, and how many ids each of ``ids`` adds."""
        odd = np.flatnonzero(ids < 0)
        blobs = [chr(c).encode("utf-8", "surrogatepass") for c in (-ids[odd] - 1).tolist()]
        size = np.ones(len(ids), dtype=np.int64)
        size[odd] = [len(b) for b in blobs]
        out = np.repeat(ids, size)
        out[out < 0] = self.pieces.first_byte + np.frombuffer(b"".join(blobs), np.uint8).astype(np.int64)
        return out, size - 1


@lru_cache(1)
def sampler_of(path: str, alpha: float, seed: int) -> Sampler:
    """One per worker: its tasks share what it has learnt, which changes no result."""
    return Sampler(path, alpha, seed)


def decode(ids: list[int], pieces: Pieces) -> str:
    """The text of ids, without the space put before it."""
    return b"".join(map(pieces.bytes.__getitem__, ids)).decode("utf-8", "replace")[1:]


def _batches(texts_: pd.Series, keys: pd.Series) -> Iterator[tuple[list[int], list[str], list[int]]]:
    at, some, chars = [], [], 0
    for k, t in enumerate(texts_):
        at.append(k)
        some.append(t)
        chars += len(t)
        if chars >= AT_ONCE:
            yield at, some, [keys[i] for i in at]
            at, some, chars = [], [], 0
    if at:
        yield at, some, [keys[i] for i in at]


def encode(docs: DataFrame, model: str, alpha: float = 1.0, seed: int = 42) -> DataFrame:
    """``doc_id`` and sampled ``ids``. An empty or missing text has none; a missing key counts as -1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = sampler_of(model, alpha, seed)
        for batch in batches:
            keys = batch["doc_id"].astype("Int64").fillna(-1).tolist()
            for at, some, k in _batches(batch["text"], keys):
                found = sampler.sample(some, k)
                yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64").iloc[at].to_numpy(dtype=object), "ids": [x.astype(np.int32) for x in found]}).astype({"doc_id": "Int64"})

    return texts(docs).mapInPandas(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, model: str, alpha: float = 1.0) -> DataFrame:
    """``doc_id`` and ``text`` of encoded documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = pieces_of(model, alpha)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text": [decode([int(i) for i in x], pieces) for x in batch["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def encoding_digest(docs: DataFrame, model: str, alpha: float = 1.0, seed: int = 42) -> DataFrame:
    """Ids of every document as count and checksum, and whether decoding gives back the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = sampler_of(model, alpha, seed)
        for batch in batches:
            keys, rows = batch["doc_id"].astype("Int64").fillna(-1).tolist(), []
            for _, some, k in _batches(batch["text"], keys):
                for text, ids in zip(some, sampler.sample(some, k)):
                    rows.append((len(text), len(ids), zlib.crc32(ids.tobytes()), decode(ids.tolist(), sampler.pieces) == text))
            out = pd.DataFrame(rows, columns=["n_chars", "n_ids", "ids_crc32", "lossless"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object))
            yield out.astype({"doc_id": "Int64"})

    return texts(docs).mapInPandas(run, "doc_id long, n_chars long, n_ids long, ids_crc32 long, lossless boolean")
