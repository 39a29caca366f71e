from collections import defaultdict

import pytest
from llm_data import documents

from smogline.llm.components import components
from smogline.llm.jaccard import jaccard_components

SCHEMA = "doc_id long, text string, component_id string, item string, label int"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in texts], SCHEMA)


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def lowest(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def brute(texts):
    sets = {i: shingles(t) for i, t in texts}
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    both = defaultdict(int)
    for ids in where.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                both[(a, b)] += 1
    edges = [(a, b) for (a, b), n in both.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    label = lowest(sets, edges)
    return sorted((i, len(sets[i]), label[i]) for i, _ in texts)


def check(spark, texts):
    assert sorted(tuple(r) for r in jaccard_components(rows(spark, texts)).collect()) == brute(texts)


def test_documents(spark):
    check(spark, documents())


def test_copies_chains_and_common_passages(spark):
    passage = " ".join(f"p{j}" for j in range(60))
    texts = [(i, passage) for i in range(30)]  # copies
    texts += [(100 + i, f"{passage} x{i}") for i in range(40)]  # near copies of each other
    texts += [(200 + i, f"{passage} " + " ".join(f"q{i}_{j}" for j in range(60))) for i in range(20)]  # only the passage in common
    chain = [f"c{j}" for j in range(60)]
    for i in range(12):
        texts.append((300 + i, " ".join(chain[i * 2 : i * 2 + 40])))  # each similar to its neighbours only
    texts += [(400, "one two"), (401, "ONE two"), (402, "one"), (403, None), (404, ""), (405, " \n"), (406, "word " * 30_000), (407, "word " * 4000)]
    texts += [(500, "a b c d e f g h"), (500, "a b c d e f g h")]
    check(spark, texts)


def test_missing_ids_and_empty_table(spark):
    found = jaccard_components(rows(spark, [(None, "a b c d e f"), (7, "a b c d e f"), (None, None), (None, "other words")])).collect()
    assert sorted((tuple(r) for r in found), key=str) == sorted([(None, 2, 7), (7, 2, 7), (None, 0, None), (None, 1, None)], key=str)
    assert jaccard_components(rows(spark, [])).collect() == []


@pytest.mark.parametrize("edges", [[(1, 2), (3, 2), (5, 5)], [(i, i + 1) for i in range(0, 200)], [(i, 1000) for i in range(50)], []])
def test_components(spark, edges):
    found = {r["item"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert found == lowest(nodes, [e for e in edges if e[0] != e[1]])


def test_verified_pairs_of_one_large_group_stay_linear(spark, monkeypatch):
    import random

    from smogline.llm import components as module

    staged, plain = [], module.stage

    def counted(df, name):
        out = plain(df, name)
        if name == "pairs":
            staged[-1] += out.count()
        return out

    monkeypatch.setattr(module, "stage", counted)
    base, chance = [f"w{j}" for j in range(100)], random.Random(3)
    for n in (150, 300):
        texts = []
        for i in range(n):
            words = list(base)
            for j in chance.sample(range(100), chance.randint(1, 3)):
                words[j] = f"x{i}_{j}"
            texts.append((i, " ".join(words)))
        staged.append(0)
        check(spark, texts)
    assert staged[1] < 3 * staged[0], staged


def test_sketches_bound_the_difference_at_any_widths(spark):
    import numpy as np

    from smogline.llm.jaccard import near, sketch_of

    chance = np.random.default_rng(5)
    pool = np.unique(chance.integers(0, 1 << 63, 200_000, dtype=np.uint64))
    cases = []
    for n, m, both in [(40, 44, 40), (500, 520, 470), (510, 600, 505), (1000, 1100, 900), (1000, 1100, 5), (5000, 4000, 3990), (5000, 5000, 100), (60_000, 60_000, 55_000), (60_000, 60_000, 9)]:
        cases.append((both, pool[:n], np.concatenate([pool[:both], pool[n : n + m - both]])))
    rows = [(k, sketch_of(x).tolist(), len(x), sketch_of(y).tolist(), len(y)) for k, (_, x, y) in enumerate(cases)]
    pairs = spark.createDataFrame(rows, "k int, s array<long>, n int, t array<long>, m int").selectExpr("k", "struct(s sketch, n size) x", "struct(t sketch, m size) y")
    kept = {wide: {r["k"] for r in pairs.where(near(75, wide)("x", "y")).collect()} for wide in (False, True)}
    links = {k for k, (both, x, y) in enumerate(cases) if 100 * both >= 75 * (len(x) + len(y) - both)}
    assert links <= kept[True] <= kept[False]
    assert kept[True] == links | {8}  # beyond the widest sketch nothing is told apart


def test_shuffle_files_go_when_a_table_is_written(spark):
    from smogline.llm.common import stage

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in blocks.getAllFiles().mkString("|").split("|") if f.endswith(".data")}

    before, setting = shuffled(), spark.conf.get(key)
    rows = stage(spark.range(10_000).repartition(3, "id"), "shuffled")
    assert not shuffled() - before
    assert rows.distinct().count() == 10_000
    assert spark.conf.get(key) == setting
