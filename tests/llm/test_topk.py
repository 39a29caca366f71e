import math

import pytest

from smogline.llm.topk import dealt, numbered, quantised, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string, block string"


def rows(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "clash", "clash") for i, v in vectors], SCHEMA)


def brute(vectors, k=10, every=100):
    import numpy as np

    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in good if i % every == 0}):
        qv, own = min((v, at) for at, (i, v) in enumerate(good) if i == q)
        best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for at, (i, v) in enumerate(good) if at != own and len(v) == len(qv))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def check(spark, vectors, **sizes):
    found = top_k(quantised(rows(spark, vectors)), **sizes).collect()
    assert sorted(tuple(r) for r in found) == brute(vectors)


def test_embeddings(spark):
    import pandas as pd

    table = pd.read_parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = [(int(i), [float(x) for x in v]) for i, v in zip(table["vec_id"], table["embedding"])]
    check(spark, vectors)
    check(spark, vectors, block=2, bins=3)


def test_ties_and_odd_vectors(spark):
    vectors = [(i, [1.0, 0.5]) for i in range(250)]  # a hot vector: all scores tie
    vectors += [(1000, None), (1001, []), (1100, [float("nan"), 1.0]), (1200, [None, 1.0]), (1300, [float("inf"), 0.0]), (None, [1.0, 1.0])]
    vectors += [(400, [-1.0, 3.0]), (401, [9.0]), (500, [0.0, 0.0]), (250, [7.5, -2.25])]
    check(spark, vectors)


def test_fewer_than_k_and_none(spark):
    check(spark, [(0, [1.0]), (1, [2.0]), (2, [-3.0])])
    check(spark, [(100, [1.0])])
    check(spark, [(1, [1.0])])
    check(spark, [])


def test_large_numbers_stay_exact(spark):
    check(spark, [(0, [250001.0, 3.0]), (1, [250001.0, 1.0]), (2, [250001.0, 2.0]), (3, [-250001.0, 2.0])])


def test_only_the_query_s_own_row_is_no_candidate(spark):
    check(spark, [(100, [1.0]), (100, [5.0]), (1, [2.0])])


def test_a_repeated_query_id_asks_with_its_smallest_vector(spark):
    others = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 2.0])]
    query = [(100, [3.0, -1.0]), (100, [-1.0, 5.0]), (100, [-1.0, 4.0]), (100, [3.0, -1.0])]
    for order in (query, query[::-1], query[2:] + query[:2]):
        found = top_k(quantised(rows(spark, order + others))).collect()
        assert sorted(tuple(r) for r in found) == brute(order + others) == brute(query + others)
        assert sum(r["vec_id"] == 100 for r in found) == 3


def test_rows_of_one_id_are_dealt_to_all_runs(spark):
    vectors = [(7, [1.0, 0.5])] * 2000 + [(1000 + i, [1.0, 0.5]) for i in range(4000)]
    sizes = [r["count"] for r in dealt(numbered(quantised(rows(spark, vectors))), 12).groupBy("run").count().collect()]
    assert len(sizes) == 12 and sum(sizes) == 6000 and max(sizes) < 700
