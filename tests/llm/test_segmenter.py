import math
from collections import Counter

import numpy as np
import public_tokenizers
from llm_data import documents

from smogline.llm.segmenter import Sampler, decode, decode_ids, encode, encoding_digest, pieces_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids string, n_ids int, lossless string"
ODD = ["", " ", "  a  b ", "▁ x▁y", "\n\n a\tb\r\n", "日本語 😀 é é", "a" * 5000, "word " * 20_000, "<s> </s> <0x41>", "▁", " ▁ "]


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "clash", 1, "x") for i, t in texts], SCHEMA)


def test_decoding_is_lossless():
    sampler = Sampler(MODEL)
    texts = ODD + [t for _, t in documents() if t]
    for text, ids in zip(texts, sampler.sample(texts, list(range(len(texts))))):
        assert decode(ids.tolist(), sampler.pieces) == text


def test_draws_follow_the_weights():
    """Shares of all segmentations of one word against their exact weights."""
    p = pieces_of(MODEL, 0.3)
    word = " thing"

    def segmentations(at):
        if at == len(word):
            yield (), 1.0
        for j in range(at + 1, len(word) + 1):
            k = p.ids.get(word[at:j])
            if k is not None:
                for rest, w in segmentations(j):
                    yield (k, *rest), w * p.weight[word[at:j]]

    exact = dict(segmentations(0))
    total, n = sum(exact.values()), 20_000
    sampler = Sampler(MODEL, 0.3)
    got = Counter(tuple(ids.tolist()) for ids in sampler.sample(["thing"] * n, list(range(n))))
    assert set(got) <= set(exact) and len(exact) > 10
    for s, w in exact.items():
        share = w / total
        assert abs(got[s] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-9


def test_same_key_same_draw_whatever_the_batch():
    texts = [t for _, t in documents() if t][:40]
    one = Sampler(MODEL).sample(texts, list(range(40)))
    other = Sampler(MODEL)
    for k in reversed(range(40)):
        assert np.array_equal(one[k], other.sample([texts[k]], [k])[0])
    assert not np.array_equal(one[0], other.sample([texts[0]], [99])[0])


def test_clearing_the_cache_changes_nothing(monkeypatch):
    texts = [t for _, t in documents() if t][:20]
    whole = Sampler(MODEL).sample(texts, list(range(20)))
    monkeypatch.setattr("smogline.llm.segmenter.NODES", 10)
    small = Sampler(MODEL)
    for k, t in enumerate(texts):
        assert np.array_equal(small.sample([t], [k])[0], whole[k])


def test_tables(spark):
    texts = documents() + [(1000 + i, t) for i, t in enumerate(ODD)] + [(5000, None), (None, "no key"), (7000, "twice"), (7000, "twice")]
    found = encode(rows(spark, texts), MODEL)
    back = [(r["doc_id"], r["text"]) for r in decode_ids(found, MODEL).collect()]
    assert sorted(back, key=str) == sorted([(i, t or "") for i, t in texts], key=str)
    digest = encoding_digest(rows(spark, texts), MODEL).collect()
    assert all(r["lossless"] for r in digest) and len(digest) == len(texts)
    sizes = Counter((r["doc_id"], len(r["ids"])) for r in found.collect())
    assert sizes == Counter((r["doc_id"], r["n_ids"]) for r in digest)
    assert encoding_digest(rows(spark, []), MODEL).collect() == []
