import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_data import documents

from pyspark.sql import functions as F

from smogline.llm import packing
from smogline.llm.packing import Encoder, inverted, knapsack, pack, patterns, pieces_of

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, sequence_id string, width int"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "en", "clash", 1) for i, t in texts], DOCS)


def test_encoder_equals_the_tokenizer():
    texts = ["", "Hello, WORLD.", "a.b, c.. d,. ,", "x<|endoftext|>y <|STARTOFTEXT|>", "ÉCOLE İstanbul Σας é. ÅB", "it's 10,000.50.", "tab\tand\x0bvt\x85nel em", "one, one. one", "a|b | c || d|, |. x"]
    whole = Tokenizer.from_file(PATH)
    found = Encoder(PATH).encode(texts)
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_encoder_parts_marks_from_words():
    words = ["é***", "é×.", "x÷,", "क़.", "e\u0301!", "²;", "ŉ%", "don'", "it's.", "'s.", "s''", "a_", "_a_", "ſ-", "日.", "a.|", "|.", "Ohm\u2126.", "...", "x<=", "<\u0338."]
    texts = [" ".join(words), *words, *[a + b for a in words for b in words]]
    whole = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, Encoder(PATH).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_encoder_on_documents():
    whole = Tokenizer.from_file(PATH)
    texts = [t or "" for _, t in documents()]
    for text, ids in zip(texts, Encoder(PATH).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_forgetting_words_changes_nothing(monkeypatch):
    texts = [t or "" for _, t in documents()]
    monkeypatch.setattr("smogline.llm.packing.REMEMBERED", 50)
    whole = Tokenizer.from_file(PATH)
    encoder = Encoder(PATH)
    for k in range(0, len(texts), 10):
        for text, ids in zip(texts[k : k + 10], encoder.encode(texts[k : k + 10])):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_words_without_ids_are_learnt_again():
    encoder = Encoder(PATH)
    text = "left over by a task that failed."
    expected = encoder.encode([text])
    encoder.known["unfinished"]  # numbered, never given ids
    assert encoder.encode([text, "unfinished"]) == [*expected, encoder.whole("unfinished").tobytes()]


def test_pieces_and_places(spark):
    texts = [(1, None), (2, ""), (3, "word " * 5000), (3, "word " * 5000), (None, "a b"), (4, "same"), (5, "same")]
    texts += documents()
    found = pack(pieces_of(rows(spark, texts), PATH)).collect()
    whole = Tokenizer.from_file(PATH)
    expected = defaultdict(int)
    for doc_id, text in texts:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 2048):
            piece = ids[s : s + 2048]
            expected[(doc_id, s, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), len(ids))] += 1
    got = defaultdict(int)
    for r in found:
        got[(r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])] += 1
    assert got == expected
    inside = defaultdict(list)
    for r in found:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in inside.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in found)
    assert len(inside) * 2048 <= 1.05 * total + 2048
    assert sorted(inside) == list(range(len(inside)))


def test_empty_table(spark):
    assert pack(pieces_of(rows(spark, []), PATH)).collect() == []


def test_knapsack_against_enumeration():
    value, pattern = knapsack(np.array([0.3, 0.55, 0.9]), np.array([2, 3, 5]), 11)
    best = max(0.3 * a + 0.55 * b + 0.9 * c for a in range(6) for b in range(4) for c in range(3) if 2 * a + 3 * b + 5 * c <= 11)
    assert value == pytest.approx(best)
    assert pattern @ [2, 3, 5] <= 11


@pytest.mark.parametrize("seed", range(5))
def test_patterns_take_every_piece_once_near_the_bound(seed):
    random = np.random.default_rng(seed)
    widths = sorted(random.choice(np.arange(1, 257), 40, replace=False).tolist())
    demand = random.integers(1, 400, 40)
    demand[3] = 100_000  # a class with most pieces
    plan = patterns(widths, demand.tolist(), 256)
    assert (sum(times * p for p, times in plan) == demand).all()
    assert all(p @ widths <= 256 for p, _ in plan)
    used = sum(times for _, times in plan)
    greedy, left = 0, demand.copy()  # largest first, without a program
    while left.any():
        room, taken = 256, np.zeros(40, dtype=int)
        for k in range(39, -1, -1):
            taken[k] = min(left[k], room // widths[k])
            room -= taken[k] * widths[k]
        times = min(left[k] // taken[k] for k in range(40) if taken[k])
        greedy += times
        left -= times * taken
    assert demand @ widths / 256 <= used <= greedy + 2


def test_inverse():
    m = np.random.default_rng(1).integers(0, 5, (30, 30)).astype(float) + np.eye(30) * 7
    assert np.allclose(inverted(m) * 1.0 @ m, np.eye(30))


def test_a_hot_id_spreads_over_the_salts(spark, monkeypatch):
    """A third of all rows under one id, equal starts and lengths: ranks are whole and no salt holds them all."""
    monkeypatch.setattr(packing, "RANKED", 100)
    listed = [(7, 0, 40, 1, 40)] * 600 + [(100 + k, 0, 10 + k % 90, k, 10 + k % 90) for k in range(1200)]
    pieces = spark.createDataFrame(listed, packing.PIECES).withColumn("piece", F.lit("clash"))
    found = packing.pack(pieces).collect()
    assert found[0].asDict().keys() == {*pieces.columns, "sequence_id", "offset"} and len(found) == 1800
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for some in by_sequence.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= 1.03 * sum(r[2] for r in listed) / 2048 + 2


def test_knapsack_against_all_patterns():
    import itertools
    import random

    pick = random.Random(1)
    for _ in range(60):
        widths = sorted(pick.sample(range(1, 13), pick.randint(1, 4)))
        prices = [pick.choice([0.0, 0.5, 1.0, pick.random()]) for _ in widths]
        value, pattern = packing.knapsack(np.array(prices), np.array(widths), 12)
        best = max(sum(p * n for p, n in zip(prices, ns)) for ns in itertools.product(range(13), repeat=len(widths)) if sum(w * n for w, n in zip(widths, ns)) <= 12)
        assert abs(value - best) < 1e-9 and abs(sum(p * n for p, n in zip(prices, pattern)) - best) < 1e-9
        assert sum(w * n for w, n in zip(widths, pattern)) <= 12


def test_a_worker_forgets_the_words_once_all_texts_are_encoded():
    path = public_tokenizers.path("word_bpe_49k.json")
    first = packing.Encoder(path).encode(["some words, and more"])
    assert packing._words(path)
    packing.forget_words()
    assert not packing._words(path) and packing.Encoder(path).encode(["some words, and more"]) == first
