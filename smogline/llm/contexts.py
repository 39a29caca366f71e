"""LM scoring (4): context-tree weighting over bytes, with a word model as base.

Every byte is eight binary decisions. A node of the tree stands for up to
``DEPTH`` preceding bytes and the bits already known; its Krichevsky-Trofimov
estimate comes from the training documents' counts. Mixing all depths, each
node weighs its own estimate against its children's product by half and half,
which gives the probability of every next byte and so a text's code length.

Texts are read once, in chunks. A chunk hands on its distinct byte grams and
words with their counts, dealt to parts by the three last context bytes or the
word's hash. Counts are added up in rounds over groups of chunks, so that no
task holds the keys of all chunks; a part solves its nodes, and answers go back
to the chunks the way that the counts came. Nothing that grows with the corpus
is broadcast. Nodes of two context bytes are added up by Spark and joined back;
only the two shallowest levels (256 contexts of 255 nodes) pass through the driver.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import fold, parts_for, texts
from smogline.llm.shingles import mix
from smogline.session import stage

DEPTH = 5
#: Context bytes by which grams are dealt to parts.
TOP = 3
#: Bytes of text in a chunk, in a block of it, and per part.
CHUNK, BLOCK, PART = 16 << 20, 1 << 20, 16 << 20
#: Chunks whose counts are added up at once.
FAN = 256
#: The token that ends a text; no word is empty.
END = b""
DOCS, WORDS, GRAMS = 0, 1, 2
LOG_HALF = float(np.log(0.5))


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def grams(blobs: list[bytes]) -> np.ndarray:
    """Every byte with its ``DEPTH`` preceding ones, and an end byte per text, as numbers; texts in a row.

    The nearest preceding byte is the highest and the byte itself the lowest, so
    that grams in order have their contexts, of any length, next to each other.
    """
    pad = bytes(DEPTH)
    b = np.frombuffer(b"".join([pad + x + b"\0" for x in blobs]), dtype=np.uint8)
    if not len(b):
        return np.empty(0, np.uint64)
    n = len(b) - DEPTH
    keys = b[DEPTH:].astype(np.uint64)
    for j in range(DEPTH):
        keys |= b[j : j + n].astype(np.uint64) << np.uint64(8 * (j + 1))
    sizes = np.array([len(x) + DEPTH + 1 for x in blobs])
    inside = np.ones(n + DEPTH, bool)
    ends = np.cumsum(sizes)
    for j in range(DEPTH):  # windows that reach into the next text
        inside[ends - 1 - j] = False
    return keys[inside[:n]]


def squeeze(values: np.ndarray) -> bytes:
    """Numbers, compressed byte place by byte place."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def spread(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).view(kind).ravel()


def squeeze_keys(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def spread_keys(data: bytes) -> np.ndarray:
    return np.cumsum(spread(data, np.uint64), dtype=np.uint64)


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keys, counts = np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


class ChunkKeys:
    """Distinct grams and words of a chunk's documents with their training counts."""

    def __init__(self):
        self.words: Counter[bytes] = Counter()
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, block: list[tuple]) -> None:
        for held in (False, True):
            blobs = [b for _, h, b in block if h is held]
            if not blobs:
                continue
            keys, n = np.unique(grams(blobs), return_counts=True)
            self.found.append((keys, n.astype(np.int64) * (not held)))
            if held:
                for b in blobs:
                    for w in (*b.split(), END):
                        self.words.setdefault(w, 0)
            else:
                for b in blobs:
                    self.words.update(b.split())
                self.words[END] += len(blobs)
        if len(self.found) > 8:
            self.found = [merged(self.found)]

    def dealt(self, kind: int, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per part its keys in order and their counts."""
        if kind == WORDS:
            keys = np.fromiter(map(word_hash, self.words), np.uint64, len(self.words))
            counts = np.fromiter(self.words.values(), np.int64, len(self.words))
            part = keys % np.uint64(parts)
        else:
            self.found = [merged(self.found)]
            [(keys, counts)] = self.found
            part = mix(keys >> np.uint64(8 * (DEPTH + 1 - TOP))) % np.uint64(parts)
        order = np.lexsort((keys, part))
        cuts = np.flatnonzero(np.diff(part[order].astype(np.int64), prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            at = order[a:b]
            yield int(part[at[0]]), keys[at], counts[at]


def pack(block: list[tuple]) -> bytes:
    head = np.array([[-1 if i is None else 0, 0 if i is None else i, h, len(b)] for i, h, b in block], np.int64)
    return zstandard.compress(len(block).to_bytes(8, "little") + head.tobytes() + b"".join([b for _, _, b in block]), 3)


def unpack(data: bytes) -> list[tuple]:
    raw = zstandard.decompress(data)
    n = int.from_bytes(raw[:8], "little")
    head, at, out = np.frombuffer(raw[8 : 8 + 32 * n], np.int64).reshape(n, 4), 8 + 32 * n, []
    for missing, i, h, size in head.tolist():
        out.append((None if missing else i, bool(h), raw[at : at + size]))
        at += size
    return out


def read_chunks(docs: DataFrame, parts: int) -> DataFrame:
    """Rows of a chunk: its documents in compressed blocks, and its keys and counts per part."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = TaskContext.get().partitionId() << 24
        number, size, keys, block, filled = 0, 0, ChunkKeys(), [], 0

        def row(kind: int, part: int, data: bytes, counts: bytes = b"") -> pd.DataFrame:
            return pd.DataFrame({"chunk": [base + number], "kind": [kind], "part": [part], "keys": [data], "counts": [counts]})

        def close() -> Iterator[pd.DataFrame]:
            for kind in (WORDS, GRAMS):
                for part, k, c in keys.dealt(kind, parts):
                    yield row(kind, part, squeeze_keys(k), squeeze(c))

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype("Int64").astype(object).tolist(), batch["text"]):
                doc_id = None if doc_id is pd.NA else doc_id
                b = fold(text)
                block.append((doc_id, held_out(doc_id), b))
                filled += len(b) + 64
                if filled >= BLOCK:
                    keys.add(block)
                    yield row(DOCS, -1, pack(block))
                    size, block, filled = size + filled, [], 0
                    if size >= CHUNK:
                        yield from close()
                        number, size, keys = number + 1, 0, ChunkKeys()
        if block:
            keys.add(block)
            yield row(DOCS, -1, pack(block))
            size += filled
        if size:
            yield from close()

    return docs.mapInPandas(run, "chunk long, kind int, part int, keys binary, counts binary")


FOUND = "chunk long, part int, keys binary, counts binary"


def totals(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of the rows with the sums of their counts."""
    return merged([(spread_keys(k), spread(c, np.int64)) for k, c in zip(group["keys"], group["counts"])])


def answers(group: pd.DataFrame, keys: np.ndarray, values: np.ndarray) -> pd.DataFrame:
    """To every row the values of its keys, in the place of its counts."""
    found = [squeeze(values[np.searchsorted(keys, spread_keys(k))]) for k in group["keys"]]
    return pd.DataFrame({"chunk": group["chunk"], "part": group["part"], "keys": group["keys"], "counts": found}, columns=["chunk", "part", "keys", "counts"])


def rounds(found: DataFrame, chunks: int) -> list[DataFrame]:
    """The chunks' counts, and what is left when up to ``FAN`` rows of a part are added up, until few are left.

    Each table's ``into`` names the row of the next one that took the row up.
    """
    tables = []
    while chunks > FAN:
        chunks = -(-chunks // FAN)
        found = found.withColumn("into", F.pmod(F.xxhash64("chunk"), F.lit(chunks)))
        tables.append(found)

        def add_up(group: pd.DataFrame) -> pd.DataFrame:
            keys, counts = totals(group)
            return pd.DataFrame({"chunk": [group["into"].iloc[0]], "part": [group["part"].iloc[0]], "keys": [squeeze_keys(keys)], "counts": [squeeze(counts)]})

        found = stage(found.groupBy("part", "into").applyInPandas(add_up, FOUND), "added")
    return [*tables, found]


def handed_down(tables: list[DataFrame], answered: DataFrame, kind: type) -> DataFrame:
    """The answers of the last round for the rows of the first one."""

    def hand(group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        return answers(group, spread_keys(above["keys"].iloc[0]), spread(above["counts"].iloc[0], kind))

    for found in tables[-2::-1]:
        answered = found.groupBy("part", "into").cogroup(answered.groupBy("part", "chunk")).applyInPandas(hand, FOUND)
    return answered


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive values, by Stirling's series from x + 8 on."""
    y = x + 8.0
    below = np.ones_like(x)
    for k in range(8):
        below *= x + k
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) - np.log(below)


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov estimate of that many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - float(np.log(np.pi))


def mixture(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of a node's probability, and the share in it of its own estimate."""
    e = kt(zeros, ones)
    log = np.logaddexp(LOG_HALF + e, LOG_HALF + below)
    return log, np.exp(LOG_HALF + e - log)


class Nodes:
    """The nodes of ``TOP`` or more context bytes that decide one bit, for grams in order."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, known: int):
        self.known = np.uint64(known)  # bits of the byte that are known already
        self.bit = ((keys >> np.uint64(7 - known)) & np.uint64(1)).astype(bool)
        node = keys >> np.uint64(8 - known)
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        self.at = np.repeat(np.arange(len(first)), np.diff(first, append=len(node)))
        self.nodes = node[first]
        ones = np.add.reduceat(counts * self.bit, first).astype(float)
        zeros = np.add.reduceat(counts, first) - ones
        logs = kt(zeros, ones)
        #: From the deepest level up: chance of a one, share of the own estimate, each deeper node's place here.
        self.levels = [((ones + 0.5) / (zeros + ones + 1), np.ones_like(logs), None)]
        for _ in range(DEPTH - TOP):
            above = self.known + np.uint64(8)
            parent = ((self.nodes >> above) << self.known) | self.prefix()
            self.nodes, up = np.unique(parent, return_inverse=True)
            zeros, ones, below = (np.bincount(up, x, len(self.nodes)) for x in (zeros, ones, logs))
            logs, own = mixture(zeros, ones, below)
            self.levels.append(((ones + 0.5) / (zeros + ones + 1), own, up))
        self.zeros, self.ones, self.logs = zeros, ones, logs

    def prefix(self) -> np.ndarray:
        return self.nodes & ((np.uint64(1) << self.known) - np.uint64(1))

    def parents(self) -> np.ndarray:
        """Numbers of the next shallower nodes: context bytes, then the known bits behind a one."""
        above = self.nodes >> (self.known + np.uint64(8))
        return ((above << np.uint64(8)) | (np.uint64(1) << self.known) | self.prefix()).astype(np.int64)

    def log10_probability(self, mixed: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Per gram, from the shallower levels' mixture and the weight that they leave, by top node."""
        for q, own, up in self.levels[::-1]:
            mixed, rest = mixed + rest * own * q, rest * (1 - own)
            if up is not None:
                mixed, rest = mixed[up], rest[up]
        p = np.clip(mixed[self.at], 1e-12, 1 - 1e-12)
        return np.log10(np.where(self.bit, p, 1 - p))


def upward(keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    """Sums for the nodes above those of the grams' part, one bit after the other."""
    out = []
    for known in range(8):
        tree = Nodes(keys, counts, known)
        node, at = np.unique(tree.parents(), return_inverse=True)
        out.append(pd.DataFrame({"node": node} | {n: np.bincount(at, x, len(node)) for n, x in (("zeros", tree.zeros), ("ones", tree.ones), ("logs", tree.logs))}))
    return pd.concat(out)


def log10_probability(keys: np.ndarray, counts: np.ndarray, above: pd.DataFrame) -> np.ndarray:
    """Per gram, given ``mixed`` and ``rest`` of the nodes above those of the grams' part."""
    above = above.sort_values("node")
    node, mixed, rest = (above[c].to_numpy() for c in ("node", "mixed", "rest"))
    total = np.zeros(len(keys))
    for known in range(8):
        tree = Nodes(keys, counts, known)
        at = np.searchsorted(node, tree.parents())
        total += tree.log10_probability(mixed[at], rest[at])
    return total


def weighed(sums: pd.DataFrame) -> pd.DataFrame:
    """Nodes of two context bytes: logarithm, share of the own estimate, chance of a one; ``up`` is the node above."""
    log, own = mixture(*(sums[c].to_numpy(float) for c in ("zeros", "ones", "logs")))
    node = sums["node"].to_numpy(np.int64)
    return pd.DataFrame({
        "node": node, "up": (node >> 16 << 8) | (node & 255), "zeros": sums["zeros"], "ones": sums["ones"], "logs": log,
        "own": own, "q": (sums["ones"] + 0.5) / (sums["zeros"] + sums["ones"] + 1),
    })


def shallow(sums: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mixture of depths 0 and 1 and the weight left for deeper ones, by node of depth 1."""
    zeros, ones, logs = (np.zeros(1 << 16) for _ in range(3))
    node = sums["up"].to_numpy(np.int64)
    zeros[node], ones[node], logs[node] = sums["zeros"], sums["ones"], sums["logs"]

    chance = lambda zeros, ones: (ones + 0.5) / (zeros + ones + 1)
    log, own = mixture(zeros, ones, logs)
    by_prefix = lambda x: x.reshape(256, 256).sum(axis=0)
    zeros0, ones0 = by_prefix(zeros), by_prefix(ones)
    _, own0 = mixture(zeros0, ones0, by_prefix(log))
    mixed0, rest0 = np.tile(own0 * chance(zeros0, ones0), 256), np.tile(1 - own0, 256)
    return mixed0 + rest0 * own * chance(zeros, ones), rest0 * (1 - own)


def lm_scores(docs: DataFrame) -> DataFrame:
    """Base and model score of every document, learnt from those outside fold 0 of 10.

    A missing or empty text is its end alone. Repeated rows count and are scored
    once each; a missing id counts as the empty text for the fold. Without
    training documents all estimates are those of no counts.
    """
    docs = texts(docs)
    parts = parts_for(docs, "text", PART)
    chunks = stage(read_chunks(docs, parts), "chunks")
    number = chunks.where(F.col("kind") == WORDS).select(F.countDistinct("chunk")).first()[0]
    words = rounds(chunks.where(F.col("kind") == WORDS).drop("kind"), number)
    found = rounds(chunks.where(F.col("kind") == GRAMS).drop("kind"), number)

    def count_words(group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = totals(group)
        sums = np.array([counts.sum(), (counts > 0).sum()], np.int64)
        return pd.concat([answers(group, keys, counts), pd.DataFrame({"chunk": [-1], "part": group["part"][:1], "keys": [b""], "counts": [squeeze(sums)]})])

    counted = stage(words[-1].groupBy("part").applyInPandas(count_words, FOUND), "words")
    stats = [spread(r["counts"], np.int64) for r in counted.where("chunk = -1").select("counts").collect()]  # a row per part
    train_tokens, distinct = sum(int(s[0]) for s in stats), sum(int(s[1]) for s in stats)
    log_total = float(np.log10(train_tokens + 0.1 * (distinct + 1)))

    def lift(group: pd.DataFrame) -> pd.DataFrame:
        return upward(*totals(group)).assign(part=group["part"].iloc[0])

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from map(weighed, batches)

    sums = stage(found[-1].groupBy("part").applyInPandas(lift, "part int, node long, zeros double, ones double, logs double"), "nodes")
    total = [F.sum(c).alias(c) for c in ("zeros", "ones", "logs")]
    pairs = sums.groupBy("node").agg(*total).mapInPandas(weigh, "node long, up long, zeros double, ones double, logs double, own double, q double")
    pairs = stage(pairs, "contexts")
    mixed, rest = shallow(pairs.groupBy("up").agg(*total).toPandas())  # 2^16 rows at most

    def mix_in(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            up, own = b["up"].to_numpy(), b["own"].to_numpy()
            yield pd.DataFrame({"node": b["node"], "mixed": mixed[up] + rest[up] * own * b["q"].to_numpy(), "rest": rest[up] * (1 - own)})

    above = pairs.select("node", "up", "own", "q").mapInPandas(mix_in, "node long, mixed double, rest double")
    above = sums.select("part", "node").join(above, "node")

    def count_grams(group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        keys, counts = totals(group)
        return answers(group, keys, log10_probability(keys, counts, above).astype(np.float32))

    scored = found[-1].groupBy("part").cogroup(above.groupBy("part")).applyInPandas(count_grams, FOUND)
    values = stage(
        handed_down(words, counted.where("chunk >= 0"), np.int64).withColumn("kind", F.lit(WORDS))
        .unionByName(handed_down(found, scored, np.float32).withColumn("kind", F.lit(GRAMS))), "values",
    )

    def score(group: pd.DataFrame) -> pd.DataFrame:
        def given(kind: int, dtype: type) -> tuple[np.ndarray, np.ndarray]:
            here = group[group["kind"] == kind]
            keys = np.concatenate([spread_keys(k) for k in here["keys"]])
            order = np.argsort(keys)
            return keys[order], np.concatenate([spread(c, dtype) for c in here["counts"]])[order]

        hashes, count = given(WORDS, np.int64)
        logs = np.log10(count + 0.1)
        distinct_grams, value = given(GRAMS, np.float32)
        number: dict[bytes, int] = {}
        out = []
        for data in group["keys"][group["kind"] == DOCS]:
            block = unpack(data)
            new = list({w for _, _, b in block for w in (*b.split(), END)}.difference(number))
            number.update(zip(new, np.searchsorted(hashes, np.fromiter(map(word_hash, new), np.uint64, len(new))).tolist()))
            every = grams([b for _, _, b in block])
            order = np.argsort(every)  # lookups in order stay near each other
            own = every[order]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            scores = np.empty(len(every))
            scores[order] = np.repeat(value[np.searchsorted(distinct_grams, own[first])], np.diff(first, append=len(own)))
            begins = np.cumsum([0] + [len(b) + 1 for _, _, b in block[:-1]])
            for (i, held, b), total in zip(block, np.add.reduceat(scores, begins)):
                words = (*b.split(), END)
                tokens = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                out.append((i, held, len(tokens), int((count[tokens] > 0).sum()), train_tokens, float(logs[tokens].sum() - len(tokens) * log_total), float(total)))
        frame = pd.DataFrame(out, columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame

    every = chunks.where(F.col("kind") == DOCS).unionByName(values)
    return every.groupBy("chunk").applyInPandas(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
