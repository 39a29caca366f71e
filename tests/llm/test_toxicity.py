import tracemalloc
import zlib

import numpy as np
import pandas as pd
from llm_data import FOLDER, documents

from smogline.llm import toxicity as tox

SCHEMA = "doc_id long, text string, toxic string, held_out string, score int"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in texts], SCHEMA)


def labelled(spark, pairs):
    return spark.createDataFrame([(i, 0, y) for i, y in pairs], "doc_id long, quality int, toxic int")


def test_gradients_against_differences():
    random = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in tox.new_network(3, random).items()}
    gates = random.normal(size=(7, 2 * tox.GATES))
    index = np.concatenate([np.arange(7), random.integers(0, 7, 3 * 5 - 7)]).reshape(3, 5)
    lengths, target = np.array([5, 3, 1]), np.array([1.0, 0.0, 1.0])
    index = np.where(np.arange(5) < lengths[:, None], index, 0)
    used, index = np.unique(index, return_inverse=True)
    index, gates = index.reshape(3, 5), gates[used]

    def loss():
        p = tox.sigmoid(tox.run(net, tox.halves(gates), index, lengths))
        return float(-(target * np.log(p) + (1 - target) * np.log(1 - p)).mean())

    grad, d_gates = tox.gradients(net, gates, index, lengths, target)
    for values, found in [*((net[k], g) for k, g in grad.items()), (gates, d_gates)]:
        flat, g = values.reshape(-1), found.reshape(-1)
        for at in random.choice(len(flat), min(12, len(flat)), replace=False):
            keep, e = flat[at], 1e-2
            flat[at] = keep + e
            up = loss()
            flat[at] = keep - e
            down = loss()
            flat[at] = keep
            assert abs((up - down) / (2 * e) - g[at]) < 2e-4 + 0.02 * abs(g[at])


def test_windows_cover_all_words():
    starts, lengths, owner = tox.windows_of([1, 48, 49, 300, 36])
    for k, (base, n) in enumerate([(0, 1), (1, 48), (49, 49), (98, 300), (398, 36)]):
        seen = {w for s, m, o in zip(starts, lengths, owner) if o == k for w in range(s, s + m)}
        assert seen == set(range(base, base + n))


def test_trigrams():
    codes, starts, counts = tox.trigrams([" ", "a", "über", "a"])
    assert counts.tolist() == [1, 1, 5, 1]
    assert codes[starts[1]] == codes[starts[3]]


def test_held_out_accuracy_and_planted_texts(spark):
    folder = FOLDER.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    found = {r["doc_id"]: r for r in tox.toxicity_digest(docs, labels).collect()}
    truth = pd.read_parquet(f"{folder}/labels.parquet").set_index("doc_id")["toxic"]
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == r["held_out"] for i, r in found.items())
    held = [(r["predicted"], truth[i]) for i, r in found.items() if r["held_out"] and i in truth.index]
    assert np.mean([p == y for p, y in held]) > 0.95
    model = tox.train(docs, labels)
    clean = [t for _, t in documents()[:60] if t and not any(w in t.lower() for w in ("idiot", "clown", "scum", "moron", "stupid"))][:10]
    planted = [(k, t + " you stupid worthless idiot, pathetic moron and clown " + t) for k, t in enumerate(clean)]
    got = {r["doc_id"]: r["toxic_score"] for r in tox.score(rows(spark, planted + [(100 + k, t) for k, t in enumerate(clean)]), model).collect()}
    assert all(got[i] >= 0.5 for i in got if i < 100) and sum(got[i] >= 0.5 for i in got if i >= 100) <= 1


def test_fitting_keeps_numbers_instead_of_words():
    random = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in random.integers(0, 40_000, 1_200)) for _ in range(400)]
    tracemalloc.start()
    tox.fit([(t, k % 2) for k, t in enumerate(texts)], 0.5, windows=256, epochs=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 110 * 2**20  # 125 MB with a text per word


def test_edges(spark):
    texts = [(1, None), (2, ""), (3, "idiot " * 30_000), (None, "x"), (4, "same"), (4, "same"), (5, "%%% !!!")]
    for pairs in ([], [(1, 0), (2, 0)], [(None, 1), (1, None)], [(3, 1), (4, 0), (5, 0), (6, 0), (1, 1), (2, 0), (3, 1)]):
        found = tox.toxicity_digest(rows(spark, texts), labelled(spark, pairs)).collect()
        assert len(found) == len(texts)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    assert tox.toxicity_digest(rows(spark, []), labelled(spark, [(1, 1)])).collect() == []
