import hashlib
from collections import Counter, defaultdict

import pytest

from llm_data import documents

from smogline.llm import exactdedup
from smogline.llm.exactdedup import PRIMES, classes, combine, dedup_digest, exact_dedup, fingerprints, polynomial, same

SCHEMA = "doc_id long, text string, row string, leader string, keep_id int, n int"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash", k, 1) for k, (i, t) in enumerate(texts)], SCHEMA)


def plain(texts):
    """(doc_id, keep_id, group_size, sha) of every row, and how many rows of each text and id are kept."""
    groups = defaultdict(list)
    for i, t in texts:
        groups[t or ""].append(i)
    best = {t: max(ids, key=lambda i: (i is not None, i or 0)) for t, ids in groups.items()}
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    return Counter((i, best[t or ""], len(groups[t or ""]), sha(t)) for i, t in texts), Counter((best[t], sha(t)) for t in groups)


def check(found, texts):
    rows, kept = plain(texts)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == rows
    assert Counter((r["doc_id"], r["text_sha256"]) for r in found if r["kept"]) == kept


EDGES = [
    (None, None), (None, ""), (1, ""), (1, ""), (2, None), (None, "no id"), (None, "no id"), (3, "once"),
    (4, "ä" * 60_000), (5, "ä" * 60_000), (6, "ä" * 59_999 + "a"), (7, "tie"), (7, "tie"), (7, "other"), (-5, "neg"), (-9, "neg"),
    (8, "Case"), (9, "case"), (10, "case "),
]


def test_values_combine():
    data = bytes(range(256)) * 700
    whole = polynomial(data)
    slow = [0, 0]
    for byte in data[:3000]:
        slow = [(v * exactdedup.PLACES[k] + byte + 1) % PRIMES[k] for k, v in enumerate(slow)]
    assert tuple(slow) == polynomial(data[:3000])
    for cut in (0, 1, 5, 32_768, 100_001, len(data)):
        left, right = polynomial(data[:cut]), polynomial(data[cut:])
        assert tuple(combine(left[k], right[k], len(data) - cut, k) for k in (0, 1)) == whole


def test_pieces_hash_like_the_whole(spark):
    texts = [(k, "äbc" * n) for k, n in enumerate((0, 1, 2, 3, 10, 1000, 5000))]
    rows = spark.createDataFrame([(i, i, t) for i, t in texts], "row long, doc_id long, text string")
    expected = {i: (len(t.encode()), *polynomial(t.encode())) for i, t in texts}
    for piece in (3, 4, 16, 1 << 20):
        found = fingerprints(rows, piece).collect()
        assert {r["row"]: (r["n_bytes"], r["h1"], r["h2"]) for r in found} == expected


def test_comparison_goes_by_chunks():
    long = "x" * 200_000
    assert same(long, "x" * 200_000) and not same(long, long[:-1] + "y") and not same(long, long[1:]) and same("", "")


def test_documents(spark):
    texts = documents() + EDGES
    check(dedup_digest(table(spark, texts)).collect(), texts)


def test_empty(spark):
    assert dedup_digest(table(spark, [])).collect() == []
    assert exact_dedup(table(spark, [])).collect() == []


def test_hot_group_meets_over_several_levels(spark):
    texts = [(i, "hot") for i in range(300)] + [(i, "warm") for i in range(300, 340)] + [(1000, "single")]
    rows = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(texts)], "row long, doc_id long, text string")
    found = classes(rows, bucket_rows=4).collect()
    sizes = {"hot": 300, "warm": 40, "single": 1}
    keeps = {"hot": 299, "warm": 339, "single": 1000}
    text = {i: t for i, t in texts}
    assert len(found) == len(texts)
    for r in found:
        assert (r["group_size"], r["keep_id"]) == (sizes[text[r["doc_id"]]], keeps[text[r["doc_id"]]])


def test_equal_fingerprints_of_different_texts(spark, monkeypatch):
    """Texts of one length all collide; comparison alone tells them apart, at every level."""
    worse = "lambda data: (len(data) % 2, 0)"
    monkeypatch.setattr(exactdedup, "polynomial", eval(worse))
    texts = [(i, f"{i % 5}abc") for i in range(200)] + [(i, "long") for i in range(200, 220)] + [(500, "z")]
    rows = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(texts)], "row long, doc_id long, text string")
    found = classes(rows, bucket_rows=3).collect()
    expected, _ = plain(texts)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["sha"].hex()) for r in found) == expected


@pytest.mark.parametrize("texts", [EDGES])
def test_rows_that_stay_have_all_columns(spark, texts):
    docs = table(spark, texts)
    found = exact_dedup(docs)
    assert found.columns == docs.columns
    _, kept = plain(texts)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert Counter((r["doc_id"], sha(r["text"])) for r in found.collect()) == kept
