import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import documents

from smogline.llm import contexts

SCHEMA = "doc_id long, text string, chunk string, score string, kind int"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in texts], SCHEMA)


def brute(texts):
    """Base scores from plain counts; model scores from a tree that is walked node by node."""
    low = [(i, (t or "").encode().lower()) for i, t in texts]
    train = [b for i, b in low if zlib.crc32(b"" if i is None else str(i).encode()) % 10]
    counts = Counter(w for b in train for w in [*b.split(), None])
    n, v = sum(counts.values()), len(counts)
    nodes, children = defaultdict(lambda: [0, 0]), defaultdict(set)
    depth = contexts.DEPTH

    def steps(b):
        b = bytes(depth) + b + b"\0"
        for p in range(depth, len(b)):
            for i in range(8):
                yield b[p - depth : p], (1 << i) | (b[p] >> (8 - i)), b[p] >> (7 - i) & 1

    for b in train:
        for context, prefix, bit in steps(b):
            for d in range(depth + 1):
                nodes[context[depth - d :], prefix][bit] += 1
                if d:
                    children[context[depth - d + 1 :], prefix].add((context[depth - d :], prefix))
    logs = {}
    estimate = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    for d in range(depth, -1, -1):
        for node, (a, b) in nodes.items():
            if len(node[0]) == d:
                e = estimate(a, b)
                logs[node] = e if d == depth else np.logaddexp(math.log(0.5) + e, math.log(0.5) + sum(logs[c] for c in children[node]))

    def chance(context, prefix, d=0):
        node = (context[depth - d :], prefix)
        if node not in nodes:
            return 0.5
        a, b = nodes[node]
        own = 1.0 if d == depth else math.exp(math.log(0.5) + estimate(a, b) - logs[node])
        return own * (b + 0.5) / (a + b + 1) + (1 - own) * (chance(context, prefix, d + 1) if d < depth else 0)

    out = []
    for i, b in low:
        tokens = [*b.split(), None]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        score = sum(math.log10(p if bit else 1 - p) for c, x, bit in steps(b) for p in [chance(c, x)])
        out.append((i, zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0, len(tokens), sum(counts[w] > 0 for w in tokens), n, base, score))
    return out


def check(spark, texts):
    found = sorted((tuple(r) for r in contexts.lm_scores(rows(spark, texts)).collect()), key=str)
    expected = sorted(brute(texts), key=str)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    for got, want in zip(found, expected):
        assert got[5:] == pytest.approx(want[5:], rel=1e-5, abs=1e-4)


def test_against_a_plain_tree(spark, monkeypatch):
    texts = [(i, (t or "")[:400]) for i, t in documents()[:40]] + [(500, None), (501, ""), (None, "no id"), (502, "Twice  here"), (502, "Twice  here"), (503, "\0 é\n")]
    check(spark, texts)
    monkeypatch.setattr(contexts, "PART", 2000)  # many parts, the same scores
    check(spark, texts)


def test_small_chunks_give_the_same(spark):
    texts = [(i, t) for i, t in documents()[:60]]
    frame = rows(spark, texts).coalesce(1)
    whole = {r["doc_id"]: r for r in contexts.lm_scores(frame).collect()}
    parted = {r["doc_id"]: r for r in contexts.lm_scores(rows(spark, texts).repartition(7)).collect()}
    for i, r in whole.items():
        assert tuple(r)[:5] == tuple(parted[i])[:5]
        assert tuple(r)[5:] == pytest.approx(tuple(parted[i])[5:], rel=1e-6)


def test_only_held_out_and_empty(spark):
    held = next(i for i in range(100) if contexts.held_out(i))
    check(spark, [(held, "never learnt")])
    assert contexts.lm_scores(rows(spark, [])).collect() == []


def key(context, symbol):
    return int.from_bytes(context[::-1], "big") << 8 | symbol


def test_probabilities_of_a_context_sum_to_one():
    random = np.random.default_rng(1)
    keys = np.array(sorted(key(c, s) for c in (b"abcde", b"qbcde") for s in range(256)), np.uint64)
    counts = random.integers(0, 50, len(keys)) * (random.random(len(keys)) < 0.1)
    nodes = contexts.weighed(contexts.upward(keys, counts))
    mixed, rest = contexts.shallow(nodes.groupby("up")[["zeros", "ones", "logs"]].sum().reset_index())
    up, own = nodes["up"].to_numpy(), nodes["own"].to_numpy()
    above = nodes.assign(mixed=mixed[up] + rest[up] * own * nodes["q"], rest=rest[up] * (1 - own))
    p = 10 ** contexts.log10_probability(keys, counts, above)
    assert p[:256].sum() == pytest.approx(1) and p[256:].sum() == pytest.approx(1)


def test_grams_hold_the_nearest_byte_highest():
    assert contexts.grams([b"ab"]).tolist() == [key(b"\0" * 5, 97), key(b"\0" * 4 + b"a", 98), key(b"\0" * 3 + b"ab", 0)]


def test_numbers_survive_being_squeezed():
    keys = np.array([0, 1, 300, 1 << 63, (1 << 64) - 1], np.uint64)
    assert contexts.spread_keys(contexts.squeeze_keys(keys)).tolist() == keys.tolist()
    assert contexts.spread(contexts.squeeze(np.array([], np.int64)), np.int64).tolist() == []


def hot():
    """A third of all grams follow one pair of bytes."""
    random = np.random.default_rng(2)
    byte = lambda n: bytes(random.integers(97, 123, n).tolist()).decode()
    return [(i, "".join(byte(1) + "zz" for _ in range(50))) for i in range(36)]


def test_counts_added_up_in_rounds_and_a_hot_context(spark, monkeypatch):
    monkeypatch.setattr(contexts, "PART", 200)
    monkeypatch.setattr(contexts, "BLOCK", 100)
    monkeypatch.setattr(contexts, "CHUNK", 100)
    monkeypatch.setattr(contexts, "FAN", 3)  # 36 chunks need three rounds
    check(spark, hot())


def test_a_hot_context_of_two_bytes_spreads_over_parts():
    keys = contexts.ChunkKeys()
    keys.add([(i, False, t.encode()) for i, t in hot()])
    found = [(sum(k >> np.uint64(32) == 0x7A7A), len(k)) for _, k, _ in keys.dealt(contexts.GRAMS, 16)]
    hot_ones, every = sum(n for n, _ in found), sum(n for _, n in found)
    assert hot_ones > every / 3.5 and max(n for n, _ in found) < hot_ones / 3


def test_better_than_words_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = [r for r in contexts.lm_scores(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
