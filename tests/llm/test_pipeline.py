from collections import Counter

import public_tokenizers
import test_jaccard
import test_linededup
from llm_data import FOLDER
from tokenizers import Tokenizer

import corpus_pipeline
from smogline.llm.common import table
from smogline.session import stage


def test_stages_against_plain_versions(spark):
    docs = table(spark, FOLDER, "documents").where("doc_id < 120")
    extra = spark.createDataFrame([(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "one two three four five six", "en", "s", 27), (902, "one two three four five six", "en", "s", 27)], docs.schema)
    docs = docs.unionByName(extra)
    kept = [stage(docs, "docs")]
    for name, function in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(function(spark, kept[-1], FOLDER), name))
        assert kept[-1].columns == docs.columns
    whole, calm, lines, single = ([(r["doc_id"], r["text"], r["n_chars"]) for r in d.collect()] for d in kept)

    assert set(calm) <= set(whole) and len(calm) > 0.7 * len(whole)
    expected = Counter()
    sizes = {i: n for i, _, n in calm}
    for i, _, removed, text in test_linededup.brute([(i, t) for i, t, _ in calm], exact=1):
        if not removed or "".join(text.split()):
            expected[(i, text, len(text) if removed else sizes[i])] += 1
    assert Counter((i, t or "", n) for i, t, n in lines) == expected
    label = {i: c for i, _, c in test_jaccard.brute([(i, t) for i, t, _ in lines])}
    has_words = {i: bool((t or "").split()) for i, t, _ in lines}
    assert sorted({i for i, _, _ in single}) == sorted(i for i in label if label[i] == i or not has_words[i])
    assert Counter(i for i, _, _ in single)[902] == 1

    pieces = corpus_pipeline.packing(spark, kept[-1], FOLDER).collect()
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = Counter()
    for i, t, _ in single:
        tokens[i] += len(encoder.encode(t or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in pieces:
        got[r["doc_id"]] += r["length"]
    assert got == tokens


def test_run_on_whole_documents(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(found.columns) and found.count() > 100


def test_extra_columns_with_clashing_names(spark):
    """Columns named like the stages' own keep their values; short lines go like long ones."""
    names = ["n_lines", "n_removed", "toxic_score", "row", "_drops", "dropped_drops", "component_id", "piece", "place"]
    text = ["short line\nanother one", "short line\nonly here", None, ""]
    docs = spark.createDataFrame([(i, t, len(t or ""), *([i * 100 + 77] * len(names))) for i, t in enumerate(text)], ["doc_id", "text", "n_chars", *names])
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, FOLDER), name)
        assert docs.columns == ["doc_id", "text", "n_chars", *names]
    found = {r["doc_id"]: r for r in docs.collect()}
    assert {i: r["text"] for i, r in found.items()} == {0: text[0], 1: "only here", 2: None, 3: ""}
    assert found[1]["n_chars"] == 9 and all(r[n] == i * 100 + 77 for i, r in found.items() for n in names)
    assert corpus_pipeline.packing(spark, docs, FOLDER).count() == 4


def test_empty_documents(spark):
    docs = table(spark, FOLDER, "documents").where("false")
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, FOLDER)
    assert docs.collect() == []


def near(spark, texts):
    found = corpus_pipeline.near_copies(spark, spark.createDataFrame(texts, "doc_id long, text string"), FOLDER)
    assert found.columns == ["doc_id", "text"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def words(name, n=40):
    return " ".join(f"{name}{j}" for j in range(n))


def test_equal_ids_with_different_texts(spark):
    a, b, c = words("a"), words("b", 30), words("c")
    # b is like nothing else; the copy of c goes for the sake of row 1, the clean row of its id stays
    texts = [(1, c), (7, a), (7, b), (9, c + " x"), (9, words("d")), (9, words("d"))]
    assert near(spark, texts) == sorted([(1, c), (7, a), (7, b), (9, words("d"))], key=str)
    assert near(spark, [(7, a), (7, a + " x"), (7, a)]) == [(7, a + " x")]


def test_copies_without_id(spark):
    a, b = words("a"), words("b")
    texts = [(None, a), (None, a), (None, a + " x"), (None, b), (3, b), (None, words("c")), (None, None), (None, " "), (None, " ")]
    expected = [(None, a + " x"), (3, b), (None, words("c")), (None, None), (None, " "), (None, " ")]
    assert near(spark, texts) == sorted(expected, key=str)


def test_each_stage_asks_for_small_batches(spark):
    """The stages may be run without ``run``."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    docs = spark.createDataFrame([(1, "one two", 7)], "doc_id long, text string, n_chars long")
    try:
        for _, function in corpus_pipeline.STAGES:
            spark.conf.set(batch, "10000")
            function(spark, docs, FOLDER)
            assert spark.conf.get(batch) == str(corpus_pipeline.BATCH)
    finally:
        spark.conf.set(batch, before)


def test_workers_get_small_batches_and_give_memory_back(spark):
    import corpus_pipeline

    corpus_pipeline.small_batches(spark)

    def seen(batches):
        import os

        for batch in batches:
            yield batch.head(1).assign(n=len(batch), pool=os.environ.get("ARROW_DEFAULT_MEMORY_POOL"))[["n", "pool"]]

    long_texts = spark.range(0, 2000, 1, 1).selectExpr("repeat('x', 20000) as text")
    found = long_texts.mapInPandas(seen, "n long, pool string").collect()
    assert sum(r["n"] for r in found) == 2000
    assert max(r["n"] for r in found) * 20_000 <= 2 * corpus_pipeline.BATCH_BYTES
    assert {r["pool"] for r in found} == {"system"}
