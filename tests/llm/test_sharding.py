import zlib
from collections import Counter

import pytest

from llm_data import documents

from smogline.llm.sharding import assign_shards, shard_digest, shuffled_buckets, write_shards

SCHEMA = "doc_id long, text string, shard string, slot string, records int"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in texts], SCHEMA)


def check(found, texts, shards=24):
    text = lambda t: (t or "").encode()
    got = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found)
    assert got == Counter((i, len(text(t)) + 8, zlib.crc32(text(t))) for i, t in texts)
    counts = Counter(r["shard"] for r in found)
    assert all(0 <= s < shards for s in counts)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(counts[s]))


@pytest.mark.parametrize("bucket_bytes", [10_000, 12 << 20])
def test_documents(spark, monkeypatch, bucket_bytes):
    monkeypatch.setattr("smogline.llm.sharding.parts_for", lambda df, c, n, most: 1 if bucket_bytes > 1 << 20 else 50)
    texts = documents() + [(7, "hot")] * 300
    found = shard_digest(rows(spark, texts)).collect()
    check(found, texts)
    order = [r["doc_id"] for r in sorted(found, key=lambda r: (r["shard"], r["slot"]))]
    assert sum(b - a == 1 for a, b in zip(order, order[1:])) < 30
    hot = Counter(r["shard"] for r in found if r["doc_id"] == 7)
    assert len(hot) == 24 and max(hot.values()) <= 21


def test_edges(spark):
    texts = [(None, None), (1, ""), (1, ""), (2, None), (3, "ä" * 100_000)]
    check(shard_digest(rows(spark, texts)).collect(), texts)
    assert shard_digest(rows(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = shard_digest(rows(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_texts_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = [(i, f"t{i}") for i in range(100)]
        placed = assign_shards(shuffled_buckets(rows(spark, texts)), 7)
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(bucket" in plan
        assert sorted((r["doc_id"], r["text"]) for r in placed.collect()) == texts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_written_shards(spark, tmp_path):
    texts = [(i, f"t{i}") for i in range(100)]
    write_shards(assign_shards(shuffled_buckets(rows(spark, texts)), 7), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == texts
    assert len({r["shard"] for r in back.collect()}) == 7
