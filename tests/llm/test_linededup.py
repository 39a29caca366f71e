import hashlib
from collections import Counter, defaultdict

import numpy as np
from llm_data import documents

from smogline.llm.linededup import LIMIT, MIN_CHARS, dedup_lines, line_digest, within
from smogline.llm.registry import op6_line_dedup

SCHEMA = "doc_id long, text string, n_lines string, drops string, id int, twin int"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash", 1, 2) for i, t in texts], SCHEMA)


def distance(a, b):
    while a and b and a[0] == b[0] and (len(a) > 500 or len(b) > 500):
        half = next(n for n in (50_000, 1000, 100, 1) if a[:n] == b[:n])
        a, b = a[half:], b[half:]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def brute(texts, exact=MIN_CHARS):
    """Components of distinct long lines within the limit, short ones alone; the smallest document keeps the first line."""
    every = {x for _, t in texts for x in (t or "").split("\n")}
    lines = sorted(x for x in every if len(x) >= MIN_CHARS)
    label = {x: x for x in every if len(x) >= MIN_CHARS or (len(x) >= exact and x.strip(" \t\n\x0b\f\r"))}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for k, a in enumerate(lines):
        for b in lines[k + 1 :]:
            if abs(len(a) - len(b)) <= LIMIT and sum((Counter(a) - Counter(b)).values()) <= LIMIT and distance(a, b) <= LIMIT:
                label[find(b)] = find(a)
    owner = defaultdict(lambda: float("inf"))
    for i, t in texts:
        for x in (t or "").split("\n"):
            if x in label and i is not None:
                owner[find(x)] = min(owner[find(x)], i)
    out = []
    for i, t in texts:
        seen, kept = set(), []
        for x in (t or "").split("\n"):
            if x in label:
                r = find(x)
                own = owner[r] == i or (i is None and owner[r] == float("inf"))
                if not own or r in seen:
                    continue
                seen.add(r)
            kept.append(x)
        out.append((i, len((t or "").split("\n")), len((t or "").split("\n")) - len(kept), "\n".join(kept)))
    return out


def check(spark, texts):
    found = line_digest(rows(spark, texts)).collect()
    got = Counter((r["doc_id"], r["n_lines"], r["n_removed"], r["n_chars"], r["text_sha256"]) for r in found)
    assert got == Counter((i, n, d, len(t), hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(texts))


def test_distance_against_the_table():
    random = np.random.default_rng(3)
    for _ in range(4000):
        a = "".join(random.choice(list("ab"), random.integers(0, 12)))
        b = list(a)
        for _ in range(random.integers(0, 4)):
            at, kind = random.integers(0, len(b) + 1), random.integers(3)
            b[at : at + (kind > 0)] = [] if kind == 1 else [random.choice(list("abc"))]
        b = "".join(b)
        for limit in (1, 2, 3):
            assert within(a, b, limit) == (distance(a, b) <= limit), (a, b, limit)


def test_documents(spark):
    check(spark, documents()[:120])


def test_altered_lines_and_edges(spark):
    random = np.random.default_rng(5)
    base = "".join(random.choice(list("abcdefgh "), 90))
    texts = [(i, f"{base}\nshort {i}") for i in range(10)]  # a hot line
    for i in range(40):  # near copies: up to three edits at any place
        line = list(base)
        for _ in range(i % 4):
            at, kind = random.integers(0, len(line)), random.integers(3)
            line[at : at + (kind > 0)] = [] if kind == 1 else ["x"]
        texts.append((100 + i, "keep me\n" + "".join(line) + "\n" + "y" * (46 + i % 5)))
    prefix = "the same beginning of many lines that go on otherwise "
    texts += [(200 + i, prefix + "".join(random.choice(list("klmnop"), 60))) for i in range(30)]
    texts += [(300, None), (301, ""), (302, "\n\n"), (303, "dup\n" * 3), (304, base + "\n" + base), (304, base + "\n" + base)]
    texts += [(305, "z" * 100_000), (306, "z" * 100_001), (307, "\n".join("w" * 60 + str(j) for j in range(60)))]
    check(spark, texts)


def test_missing_ids_and_empty_table(spark):
    line = "a line that is long enough to be compared with the other lines"
    got = sorted((r["doc_id"], r["text"], r["n_removed"]) for r in dedup_lines(rows(spark, [(3, line), (None, line + "!"), (5, None)])).collect() if r["doc_id"])
    assert got == [(3, line, 0), (5, None, 0)]
    [lone] = [r for r in dedup_lines(rows(spark, [(None, line + "\n" + line), (3, "x")])).collect() if r["doc_id"] is None]
    assert lone["text"] == line
    assert dedup_lines(rows(spark, [])).collect() == []


def test_op6_removes_exact_copies_of_short_lines(spark, tmp_path):
    long = "a line that is long enough to be compared with the other lines"
    texts = [(1, "To.\n\nThe.\n" + long), (2, "To.\n\nTa.\n" + long + "!"), (3, "The.\n  \nTo.\nThe.\nmine"), (4, "\n  \nmine\nmine"), (5, None)]
    expected = [(1, 0, texts[0][1]), (2, 2, "\nTa."), (3, 3, "  \nmine"), (4, 2, "\n  "), (5, 0, "")]
    rows(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted((r["doc_id"], r["n_removed"], r["text_sha256"]) for r in op6_line_dedup(spark, str(tmp_path)).collect())
    assert found == [(i, n, hashlib.sha256(t.encode()).hexdigest()) for i, n, t in expected]
