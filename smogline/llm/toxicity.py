"""Toxicity (10): a bidirectional gated recurrent network with attention pooling.

A word enters as an embedding of the word itself, if the sample knows it, and
the mean embedding of its character trigrams. Two gated recurrent layers read
a window of words from both ends, attention pools their states, and a text's
score is that of its most toxic window; windows overlap and cover whole texts.

The network is trained in numpy, in one task, on a bounded sample of labelled
rows (``toxic_rows`` and ``clean_rows`` documents, ``windows`` windows). A
logistic curve over the sample's highest window logits turns them into scores.
Labels, language, source and id never enter a score.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import texts

WORD = re.compile(r"[^\W_]+")
WIDTH, STRIDE = 48, 36
HIDDEN, DIMS, TRIGRAMS = 8, 12, 4096
GATES = 3 * HIDDEN
#: Bounds of the training sample: documents by label, windows that are fitted.
TOXIC_ROWS, CLEAN_ROWS, WINDOWS = 800, 1600, 8_000
#: Words whose gate inputs a worker keeps; windows that run at once.
KEPT, AT_ONCE = 150_000, 2048
#: Words whose trigrams are looked up together.
SPELT = 8192


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def new_network(words: int, random: np.random.Generator) -> dict[str, np.ndarray]:
    """Parameters. Row 0 of ``word`` stands for words that the sample does not know."""
    small = lambda *shape: random.normal(0, 0.25, shape).astype(np.float32)
    net = {"word": small(words + 1, DIMS), "char": small(TRIGRAMS, DIMS), "in": small(2 * DIMS, 2 * GATES), "in_b": np.zeros(2 * GATES, np.float32)}
    for side in "fb":
        net |= {f"u{side}": small(HIDDEN, GATES), f"c{side}": np.zeros(GATES, np.float32)}
    net |= {"att": small(2 * HIDDEN, HIDDEN), "att_b": np.zeros(HIDDEN, np.float32), "att_v": small(HIDDEN), "out": small(2 * HIDDEN), "out_b": np.zeros(1, np.float32)}
    return net


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram numbers of all words in a row, where each word's begin, and how many it has."""
    framed = [f"<{w}>".encode("utf-8", "replace") for w in words]
    sizes = np.array([len(b) for b in framed], dtype=np.int64)
    b = np.frombuffer(b"".join(framed) + b"\0\0", dtype=np.uint8).astype(np.uint32)
    codes = (((b[:-2] * 961 + b[1:-1] * 31 + b[2:]) * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    keep = np.arange(len(codes)) < np.repeat(starts + sizes - 2, sizes)
    counts = sizes - 2
    return codes[keep], np.cumsum(counts) - counts, counts


def inputs(net: dict, known: np.ndarray, codes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    x = np.empty((len(known), 2 * DIMS), np.float32)
    x[:, :DIMS] = net["word"][known]
    for at in range(0, len(known), SPELT):
        some = slice(at, at + SPELT)
        end = starts[at + SPELT] if at + SPELT < len(known) else len(codes)
        chars = np.add.reduceat(net["char"][codes[starts[at] : end]], starts[some] - starts[at], axis=0)
        x[some, DIMS:] = chars / counts[some, None]
    return x


def halves(gates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.ascontiguousarray(gates[:, :GATES]), np.ascontiguousarray(gates[:, GATES:])


def run(net: dict, gates: tuple[np.ndarray, np.ndarray], index: np.ndarray, lengths: np.ndarray, keep: bool = False):
    """Logits of windows. ``gates`` holds words' inputs to either layer, ``index`` the words of each window."""
    n, width = index.shape
    states, saved = np.zeros((2, width, n, HIDDEN), np.float32), []
    live = np.arange(width)[:, None] < lengths  # (width, n)
    for k, side in enumerate("fb"):
        u, c = net[f"u{side}"], net[f"c{side}"]
        h = np.zeros((n, HIDDEN), np.float32)
        mine = gates[k]
        for t in range(width) if side == "f" else range(width - 1, -1, -1):
            g, r = mine[index[:, t]], h @ u + c
            zr = sigmoid(g[:, : 2 * HIDDEN] + r[:, : 2 * HIDDEN])
            z, reset = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(g[:, 2 * HIDDEN :] + reset * r[:, 2 * HIDDEN :])
            on = live[t][:, None]
            after = np.where(on, new + z * (h - new), h)
            if keep:
                saved.append((k, t, h, z, reset, new, r[:, 2 * HIDDEN :], on))
            h = after
            states[k, t] = h
    both = np.concatenate([states[0], states[1]], axis=2)  # (width, n, 2 hidden)
    a = np.tanh(both @ net["att"] + net["att_b"])
    s = np.where(live, a @ net["att_v"], -1e9)
    w = np.exp(s - s.max(axis=0)) * live
    w /= np.maximum(w.sum(axis=0), 1e-9)
    pooled = (w[:, :, None] * both).sum(axis=0)
    logits = pooled @ net["out"] + net["out_b"][0]
    return (logits, saved, both, a, w, pooled) if keep else logits


def gradients(net: dict, gates: np.ndarray, index: np.ndarray, lengths: np.ndarray, targets: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the mean logistic loss for the parameters and for ``gates``."""
    logits, saved, both, a, w, pooled = run(net, halves(gates), index, lengths, keep=True)
    d = ((sigmoid(logits) - targets) / len(targets)).astype(np.float32)
    grad = {k: np.zeros_like(v) for k, v in net.items() if k not in ("word", "char", "in", "in_b")}
    grad["out"], grad["out_b"] = pooled.T @ d, np.array([d.sum()], np.float32)
    d_pooled = d[:, None] * net["out"]
    d_both = w[:, :, None] * d_pooled
    d_w = (both * d_pooled).sum(axis=2)
    d_s = w * (d_w - (w * d_w).sum(axis=0))
    d_a = d_s[:, :, None] * net["att_v"] * (1 - a * a)
    grad["att_v"] = np.einsum("tn,tnk->k", d_s, a)
    grad["att"], grad["att_b"] = np.einsum("tni,tnk->ik", both, d_a), d_a.sum(axis=(0, 1))
    d_both += d_a @ net["att"].T
    by_step = np.zeros((*index.shape, 2 * GATES), np.float32)
    d_h = [np.zeros((len(d), HIDDEN), np.float32) for _ in range(2)]
    for k, t, h, z, reset, new, inner, on in reversed(saved):
        side = "fb"[k]
        total = d_h[k] + d_both[t][:, k * HIDDEN : (k + 1) * HIDDEN]
        live = total * on
        d_new = live * (1 - z) * (1 - new * new)
        d_z = live * (h - new) * z * (1 - z)
        d_r = d_new * inner * reset * (1 - reset)
        to_gates = np.concatenate([d_z, d_r, d_new], axis=1)
        to_state = np.concatenate([d_z, d_r, d_new * reset], axis=1)
        grad[f"u{side}"] += h.T @ to_state
        grad[f"c{side}"] += to_state.sum(axis=0)
        d_h[k] = total * (1 - on) + live * z + to_state @ net[f"u{side}"].T
        by_step[:, t, k * GATES : (k + 1) * GATES] = to_gates
    order = np.argsort(index, axis=None, kind="stable")
    first = np.flatnonzero(np.diff(index.reshape(-1)[order], prepend=-1))  # every word occurs
    return grad, np.add.reduceat(by_step.reshape(-1, 2 * GATES)[order], first, axis=0)


def windows_of(sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of every window over texts put in a row, and the text it belongs to."""
    starts, lengths, owner, base = [], [], [], 0
    for k, n in enumerate(sizes):
        for s in range(0, max(1, n - WIDTH + STRIDE), STRIDE):
            starts.append(base + s)
            lengths.append(min(WIDTH, n - s))
            owner.append(k)
        base += n
    return np.array(starts, np.int64), np.array(lengths, np.int64), np.array(owner, np.int64)


def window_index(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    at = starts.astype(np.int32)[:, None] + np.arange(WIDTH, dtype=np.int32)  # a batch has far fewer than 2^31 words
    np.minimum(at, len(words) - 1, out=at)
    index = words[at]
    index[np.arange(WIDTH) >= lengths[:, None]] = 0
    return index


def tokens(text: str) -> list[str]:
    """Words in lower case; a text without words is one blank word."""
    return WORD.findall(text.lower()) or [" "]


class Scorer:
    """Highest window logit of texts."""

    def __init__(self, model: dict):
        self.net, self.vocabulary = model["net"], model["vocabulary"]
        self.rows: dict[str, int] = {}
        self.gates = [np.zeros((KEPT, GATES), np.float32) for _ in "fb"]

    def logits(self, batch: list[str]) -> np.ndarray:
        words = [tokens(t) for t in batch]
        if len(self.rows) > KEPT:
            self.rows = {}
        new = [w for w in {w for some in words for w in some} if w not in self.rows]
        if new:
            known = np.array([self.vocabulary.get(w, 0) for w in new])
            x = inputs(self.net, known, *trigrams(new))
            at = len(self.rows)
            for k, half in enumerate(halves(x @ self.net["in"] + self.net["in_b"])):
                if at + len(new) > len(self.gates[k]):
                    self.gates[k] = np.concatenate([self.gates[k][:at], np.zeros((at + 2 * len(new), GATES), np.float32)])
                self.gates[k][at : at + len(new)] = half
            self.rows.update(zip(new, range(at, at + len(new))))
        rows = self.rows
        flat = np.array([rows[w] for some in words for w in some], np.int64)
        starts, lengths, owner = windows_of([len(w) for w in words])
        best = np.full(len(batch), -np.inf)
        for at in range(0, len(starts), AT_ONCE):
            some = slice(at, at + AT_ONCE)
            found = run(self.net, tuple(self.gates), window_index(flat, starts[some], lengths[some]), lengths[some])
            np.maximum.at(best, owner[some], found)
        return best


def fit(rows: list[tuple[str, int]], toxic_share: float, windows: int = WINDOWS, epochs: int = 4, seed: int = 7) -> dict:
    """Train on (text, label) rows. The vocabulary is the words of three or more of them."""
    random = np.random.default_rng(seed)
    labels = np.array([y for _, y in rows], np.float32)
    found: dict[str, int] = {}
    words = [np.array([found.setdefault(w, len(found)) for w in tokens(t)], np.int32) for t, _ in rows]  # numbers, not texts
    seen = np.bincount(np.concatenate([np.unique(w) for w in words]), minlength=len(found))
    every = sorted(found)
    order = np.array([found[w] for w in every])
    number = np.empty(len(every), np.int32)
    number[order] = np.arange(len(every))
    vocabulary = {w: k + 1 for k, w in enumerate(w for w, n in zip(every, seen[order]) if n >= 3)}
    flat = number[np.concatenate(words)]
    known = np.array([vocabulary.get(w, 0) for w in every])
    codes, first, counts = trigrams(every)
    starts, lengths, owner = windows_of([len(w) for w in words])
    index = window_index(flat, starts, lengths)
    target = labels[owner]
    net = new_network(len(vocabulary), random)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    step = 0
    # as many windows of toxic as of clean documents
    sides = [np.flatnonzero(target == y) for y in (0, 1)]
    each = min(windows // 2, max(map(len, sides)))
    for epoch in range(epochs):
        if epoch == epochs // 2:  # from here on a toxic document's most toxic windows stand for it
            whole = halves(inputs(net, known, codes, first, counts) @ net["in"] + net["in_b"])
            logits = np.concatenate([run(net, whole, index[i : i + AT_ONCE], lengths[i : i + AT_ONCE]) for i in range(0, len(index), AT_ONCE)])
            best = np.full(len(rows), -np.inf)
            np.maximum.at(best, owner, logits)
            sides[1] = np.flatnonzero((target == 1) & (logits >= best[owner] - 1))
        order = random.permutation(np.concatenate([random.choice(s, each, replace=len(s) < each) for s in sides]))
        for at in range(0, len(order), 128):
            pick = order[at : at + 128]
            used, local = np.unique(index[pick], return_inverse=True)
            local = local.reshape(index[pick].shape)
            spans = np.repeat(first[used] - np.concatenate([[0], np.cumsum(counts[used])[:-1]]), counts[used]) + np.arange(counts[used].sum())
            mine, begins = codes[spans], np.cumsum(counts[used]) - counts[used]
            x = inputs(net, known[used], mine, begins, counts[used])
            grad, d_gates = gradients(net, x @ net["in"] + net["in_b"], local, lengths[pick], target[pick])
            grad["in"], grad["in_b"] = x.T @ d_gates, d_gates.sum(axis=0)
            d_x = d_gates @ net["in"].T
            grad["word"], grad["char"] = np.zeros_like(net["word"]), np.zeros_like(net["char"])
            np.add.at(grad["word"], known[used], d_x[:, :DIMS])
            np.add.at(grad["char"], mine, np.repeat(d_x[:, DIMS:] / counts[used][:, None], counts[used], axis=0))
            step += 1
            for k, g in grad.items():
                m, v = moments[k]
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                net[k] -= (0.01 / (1 - 0.9**step)) * m / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    model = {"net": net, "vocabulary": vocabulary}
    scorer = Scorer(model)
    best = np.concatenate([scorer.logits([t for t, _ in rows[i : i + 64]]) for i in range(0, len(rows), 64)])
    share = labels.mean()
    weight = np.where(labels == 1, toxic_share / share, (1 - toxic_share) / (1 - share))  # as frequent as among all labels
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic curve
        p = sigmoid(slope * best + shift)
        g = np.array([(weight * (p - labels) * best).sum() + 1e-2 * (slope - 1), (weight * (p - labels)).sum()])
        v = weight * p * (1 - p) + 1e-9
        h11, h12, h22 = (v * best * best).sum() + 1e-2, (v * best).sum(), v.sum() + 1e-6
        det = h11 * h22 - h12 * h12
        slope, shift = slope - np.clip((h22 * g[0] - h12 * g[1]) / det, -1, 1), shift - np.clip((h11 * g[1] - h12 * g[0]) / det, -1, 1)
    return model | {"slope": float(max(slope, 1e-3)), "shift": float(shift)}


def fold(doc_id: Column, parts: int) -> Column:
    """Remainder of the CRC-32 of the id as text; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, windows: int = WINDOWS) -> bytes | None:
    """Fit on a sample of the labelled documents outside fold 0 of 5; none if a class has no document.

    The sample is the rows with the smallest hashes, so it does not depend on
    partitions. The task that fits it hands back one row with the model.
    """
    usable = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null")
    usable = usable.where(fold(F.col("doc_id"), 5) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = lambda y, n: usable.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    share = usable.agg(F.avg("toxic")).first()[0]
    if share is None or share in (0.0, 1.0):
        return None
    picked = some(1, toxic_rows).unionByName(some(0, clean_rows))  # toxic_rows + clean_rows rows
    sample = texts(docs).join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        rows = list(zip(group["text"], group["toxic"].astype(int)))
        both = {y for _, y in rows} == {0, 1}
        return pd.DataFrame({"model": [pickle.dumps(fit(rows, share, windows)) if both else None]})

    found = sample.groupBy().applyInPandas(one, "model binary").collect()
    return bytes(found[0]["model"]) if found and found[0]["model"] is not None else None


def score(docs: DataFrame, model: bytes | None, name: str = "toxic_score") -> DataFrame:
    """All rows and columns of ``docs`` with the score added as ``name`` (replaced if it is there); 0 without a model.

    A missing or empty text is scored as a blank word; repeated rows stay; an
    empty table gives an empty table.
    """
    added = [c for c in docs.columns if c != name]
    if model is None:
        return docs.select(*added, F.lit(0.0).alias(name))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = pickle.loads(shared.value)
        scorer = Scorer(fitted)
        for batch in batches:
            found, some, chars = [], [], 0
            for text in batch:
                some.append(text)
                chars += len(text)
                if chars > 300_000:
                    found.append(scorer.logits(some))
                    some, chars = [], 0
            if some:
                found.append(scorer.logits(some))
            logits = np.concatenate(found) if found else np.zeros(0)
            yield pd.Series(sigmoid(fitted["slope"] * logits + fitted["shift"]).astype(float))

    return docs.select(*added, scores(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias(name))


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` per row; texts, repeats and empty tables as in ``score``."""
    plain = texts(docs)
    found = score(plain, train(plain, labels))
    return found.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
    )
