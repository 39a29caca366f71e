import hashlib
import random
import re

import pytest

from llm_data import documents

from smogline.llm.frames import Frames, arranged, draw, fill_in_middle, fim_digest, frame_store, restore_texts, restored

SCHEMA = "doc_id long, text string, n string, form int, data string, output int"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "clash", 1, "clash", 1) for i, t in texts], SCHEMA)


def plain(doc_id, text):
    """Row of the digest, by lists of units."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)
    n = len(units)
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(text), sha(text)), text
    if h4 % 100 < 20:
        form, output = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, output = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, n, form, len(prefix), len(middle), sha(output), sha(text)), output


EDGES = [
    (None, None), (None, "no id, some words"), (1, ""), (1, ""), (2, "<P>"), (3, "a<S>b"), (4, "x <M"), (5, "<P <S <M "),
    (6, "ä" * 5000), (7, "word" * 30_000), (8, "a b " * 30_000), (9, "\r\n\x00  tab\t"), (10, "😀 smile 😀" * 50),
    (11, "[[]]@@``{{zZaA"), (12, "İıſK"), (13, "<<<S"), (14, "<"), (14, "<"),
]


@pytest.mark.parametrize("size", [3, 7, 64, 1 << 15])
def test_digest_of_documents(spark, size):
    texts = EDGES + documents()[:: 1 if size > 100 else 9]
    if size < 10:
        texts = [(i, t) for i, t in texts if len(t or "") < 3000]
    found = sorted((tuple(r) for r in fim_digest(table(spark, texts), size).collect()), key=str)
    assert found == sorted((plain(i, t)[0] for i, t in texts), key=str)
    assert {r[2] for r in found} == {"plain", "psm", "spm"} or size < 10


def test_empty_table(spark):
    assert fim_digest(table(spark, [])).collect() == []


def test_outputs_and_restored_texts(spark):
    texts = EDGES + [(i, f"text {i} with words, and more") for i in range(100, 160)]
    outputs = fill_in_middle(frame_store(table(spark, texts), 16), 16)
    found = outputs.collect()
    assert sorted((str(r["doc_id"]), r["form"], r["output"]) for r in found) == sorted(
        (str(i), plain(i, t)[0][2], plain(i, t)[1]) for i, t in texts
    )
    back = restore_texts(outputs.selectExpr("doc_id", "form", "output", "'x' AS text")).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t in texts)


def test_frames_are_sought_one_at_a_time(monkeypatch):
    pick = random.Random(3)
    text = "".join(pick.choice(["word", " ", "ä", "1", "Long" * 9, "\n", "<S"]) for _ in range(3000))
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)
    places = [0]
    for u in units:
        places.append(places[-1] + len(u))
    for size in (1, 2, 5, 50, 1000):
        cuts = [0, len(text) // 3, len(text) // 2, len(text)]
        frames = Frames.of([text[a:b] for a, b in zip(cuts, cuts[1:])], size)
        assert (frames.n, frames.n_chars) == (len(units), len(text))
        assert "".join(frames.read()) == text
        opened = []
        monkeypatch.setattr(Frames, "frame", lambda self, k, read=Frames.frame: opened.append(k) or read(self, k))
        for u in range(0, len(units) + 1, 37):
            opened.clear()
            assert frames.place(u) == places[u] and len(opened) <= 1
            a, b = sorted((places[u], pick.choice(places)))
            opened.clear()
            assert "".join(frames.read(a, b)) == text[a:b] and len(opened) <= (b - a) // size + 2
        monkeypatch.undo()
        assert frames.find("<S") == text.find("<S") and frames.find("<S", 700) == text.find("<S", 700)
        assert frames.find("nowhere") == -1


def test_markers_at_the_seams():
    for text in ("a<S b<P c<M", "<P" * 20, "<S<M<P", "ab<"):
        frames = Frames.of([text], 2)
        for form in ("psm", "spm", "plain"):
            for a in range(len(text) + 1):
                for b in range(a, len(text) + 1):
                    output = Frames.of(arranged(frames, form, a, b), 3)
                    assert "".join(restored(output, form)) == text


def test_draw():
    assert draw(1, 0, True) == ("plain", 0, 0)
    forms = [draw(i, 10, False)[0] for i in range(5000)]
    assert 0.08 < forms.count("plain") / 5000 < 0.12 and 0.15 < forms.count("spm") / 5000 < 0.21
