import hashlib

from llm_data import documents

from smogline.llm.simhash import edited_fingerprints, fingerprint, fingerprints, likeness, within_radius

SCHEMA = "doc_id long, text string, bucket string, place string, n int"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in texts], SCHEMA)


def expected(texts):
    out = []
    order = sorted([(-(2**63) if i is None else i, t or "", i) for i, t in texts], key=lambda x: (-x[0], x[1]))
    for k, (_, text, doc_id) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own = fingerprint(text)
        other = fingerprint(edited)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.hex(), other.hex(), likeness(own, other), likeness(own, fingerprint(after))))
    return sorted(out, key=str)


def check(spark, texts):
    found = edited_fingerprints(rows(spark, texts)).collect()
    assert sorted([tuple(r) for r in found], key=str) == expected(texts)
    return found


def test_documents(spark, monkeypatch):
    texts = documents()
    found = check(spark, texts)
    mean = lambda name: sum(r[name] for r in found) / len(found)
    assert mean("near_edited") > mean("near_next") + 0.1
    monkeypatch.setattr("smogline.llm.simhash.BUCKET_BYTES", 20_000)  # many ranges give the same rows
    check(spark, texts)


def test_edges(spark):
    check(spark, [(5, "only one")])
    check(spark, [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b c d e f g"), (9, "ä😀" * 3000), (7, "x y"), (7, "x z")])
    assert edited_fingerprints(rows(spark, [])).collect() == []


def test_within_radius_against_all_pairs(spark):
    base = int.from_bytes(hashlib.md5(b"x").digest())
    values = {base}
    for k in range(60):
        flip = int.from_bytes(hashlib.md5(str(k).encode()).digest())
        value = base
        for j in range(1 + k % 6):
            value ^= 1 << (flip >> (7 * j)) % 128
        values.add(value)
        values.add(flip)
    prints = [v.to_bytes(16).hex() for v in values]
    got = {(r["a"], r["b"], r["distance"]) for r in within_radius(spark.createDataFrame([(p,) for p in prints * 2] + [(None,)], "fingerprint string")).collect()}
    want = {(a, b, d) for a in prints for b in prints if a < b and (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= 3}
    assert got == want and len(want) > 50


def test_equal_texts_have_equal_fingerprints(spark):
    found = {r["doc_id"]: r["fingerprint"] for r in fingerprints(rows(spark, [(1, "A b c d e f g"), (2, "A b c d e f g"), (3, None), (4, "")])).collect()}
    assert found[1] == found[2] and found[3] == found[4] == "0" * 32
