import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_data import documents

from smogline.llm.periodic import collapse_runs, periodic_runs, planted, run_digest, runs_of, runs_of_all

SCHEMA = "doc_id long, text string, start string, period string, n_runs int"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in texts], SCHEMA)


def plain_runs(words, least=6, times=4):
    """Every period, every start."""
    n, found = len(words), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            run = words[i : j + q]
            if len(run) >= max(least, times * q):
                if not any(all(run[t] == run[t + r] for t in range(len(run) - r)) for r in range(1, q)):
                    found.append((i, len(run), q))
            i = j + 1
    return sorted(found)


def plain_digest(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = (None,) * 4
    if runs:
        s, length, q = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]))
        best = (s, length, q, 1000 * length // q)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    kept = [w for i, w in enumerate(words) if i not in dropped]
    return (doc_id, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(kept)), n, len(kept))


def made(seed):
    """Words with repeating stretches in them."""
    pick = random.Random(seed)
    n, letters = pick.randint(0, 150), pick.choice([1, 2, 3, 6, 40])
    words = [pick.randrange(letters) for _ in range(n)]
    for _ in range(pick.randint(0, 3)):
        if n:
            start, period = pick.randrange(n), pick.randint(1, max(1, n // 4))
            for i in range(start, min(n, start + period * pick.randint(2, 8) + pick.randint(0, 3))):
                words[i] = words[start + (i - start) % period]
    return words


@pytest.mark.parametrize("least, times", [(6, 4), (2, 3), (20, 5)])
def test_runs_against_all_periods(least, times):
    together = []
    for seed in range(600):
        words = made(seed)
        expected = plain_runs(words, least, times)
        assert runs_of(words, least, times) == expected
        together.append((words, expected))
    for at in range(0, 600, 50):  # with candidate stretches, several documents in a row
        some = together[at : at + 50]
        found = runs_of_all([np.array(w, np.int64) for w, _ in some], least, times)
        assert found == [e for _, e in some]


def test_two_periods_are_runs_too():
    for seed in range(200):
        words = made(seed)
        assert runs_of(words, 2, 2) == plain_runs(words, 2, 2)
    with pytest.raises(ValueError):
        runs_of_all([np.array([1, 1])], 2, 2)


def test_long_periods():
    for period in (7, 8, 9, 15, 16, 17, 31, 33, 500):
        words = [-1 - k for k in range(30)] + [k % period for k in range(4 * period + 3)] + [9999, 9998]
        words = [w + 40 for w in words]
        [found] = runs_of_all([np.array(words, np.int64)])
        assert found == [(30, 4 * period + 3, period)]
        short = words[: 30 + 4 * period - 1]
        assert runs_of_all([np.array(short, np.int64)]) == [[]]


def test_digest_of_all_documents(spark):
    texts = documents()
    found = run_digest(table(spark, texts)).collect()
    expected = Counter(plain_digest(i, t) for i, t in texts if len((t or "").split()) < 800)
    got = Counter(tuple(r) for r in found if r["n_words"] < 800)
    assert got == expected
    assert len(found) == len(texts) and sum(r["n_runs"] for r in found) > 0


def test_edges(spark):
    texts = [
        (None, "a a a a a a"), (None, None), (1, ""), (1, ""), (2, None), (3, " \t\x0b\x0c\r\n"), (4, "x x " * 9),
        (5, "a b " * 40 + "c d e " * 40), (6, "a a a a a a b b b b b b"), (7, "a a a a a"), (30, "one"),
    ]
    texts += [(i, f"w{i} " + "p q r " * (i % 7)) for i in range(40, 140)] + [(8, "hot " * 50)] * 60
    found = run_digest(table(spark, texts)).collect()
    assert Counter(tuple(r) for r in found) == Counter(plain_digest(i, t) for i, t in texts)
    assert run_digest(table(spark, [])).collect() == []
    assert any(planted(i, 5) is not None for i, _ in texts if i)


def test_very_long_text(spark):
    words = " ".join(f"w{k * k % 7919}" for k in range(40_000))
    text = words + " x" + " a b c d e f g" * 5_000
    [run] = periodic_runs(table(spark, [(1, text)])).where("period = 7").collect()
    assert tuple(run) == (1, 40_001, 35_000, 7)
    [row] = collapse_runs(table(spark, [(1, text)])).collect()
    assert row["text"].endswith("x a b c d e f g")


def test_collapsed_texts(spark):
    texts = [(1, "a  b\n\nc"), (2, "start " + "x y " * 5 + "end"), (None, None)]
    found = collapse_runs(table(spark, texts)).collect()
    assert [(r["doc_id"], r["text"]) for r in found] == [(1, "a  b\n\nc"), (2, "start x y end"), (None, "")]
