"""What a step shuffles, writes or holds as its input grows."""

from __future__ import annotations

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from smogline.operators import split
from smogline.operators.correlation import correlation_matrix
from smogline.plans import observations as source
from smogline.plans import queries
from smogline.schema import CORRELATED


def test_one_large_file_is_not_dealt_to_a_fixed_number_of_tasks(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(0, 400_000, 1, 1).write.option("parquet.block.size", 1 << 16).parquet(path)
    scan = spark.read.parquet(path)
    assert len(scan.inputFiles()) == 1
    small = source.spread(scan, scan)
    assert "RoundRobinPartitioning(4)" in plan(small) and small.count() == 400_000
    settings = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        large = source.spread(scan, spark.read.parquet(path))
        assert "RoundRobin" not in plan(large) and large.count() == 400_000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_lines_are_not_shuffled_for_few_sellers(spark, folder, monkeypatch):
    """Whatever Spark's own bound: at 360 times sf0.1 sellers are beyond it, and the widest rows were shuffled for them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = source.observations(spark, folder)
        assert "s_suppkey" not in "".join(line for line in plan(few).splitlines() if "hashpartitioning" in line)
        monkeypatch.setattr(source, "FEW_SELLERS", 0)
        many = source.observations(spark, folder)
        assert "hashpartitioning(s_suppkey" in plan(many)
        assert few.exceptAll(many).isEmpty() and few.count() == many.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_tables_are_staged_tightly(spark, folder):
    files = source.staged_observations(spark, folder).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert rows(source.staged_observations(spark, folder).groupBy().count()) == [(6_126,)]


def test_even_keys_need_one_scan(spark, monkeypatch):
    df = spark.range(20_000).select("id", F.concat(F.lit("c"), F.col("id") % 3).alias("label"))
    searched = sorted(rows(split.stratified_split(df, "label", ranked_rows=50))), sorted(rows(split.random_split(df, ranked_rows=50)))

    def never(*_):
        raise AssertionError("even keys are searched by levels")

    monkeypatch.setattr(split, "_searched_thresholds", never)
    monkeypatch.setattr(split, "select_ranks", never)
    assert (sorted(rows(split.stratified_split(df, "label"))), sorted(rows(split.random_split(df)))) == searched


def test_keys_that_are_not_even_are_searched(spark):
    df = spark.range(9_000).select("id", F.concat(F.lit("c"), F.col("id") % 3).alias("label"))
    marked = split.stratified_split(df, "label", F.col("id") + (1 << 51))
    assert rows(marked.groupBy("label").agg(F.count_if("is_test"), F.max(F.when(F.col("is_test"), F.col("id"))) < 1_810).orderBy("label")) == [
        (f"c{k}", 600, True) for k in range(3)
    ]


def test_the_board_stages_only_what_it_reads(spark, folder):
    queries._board(spark, folder)
    staged = {kind: df.columns for (app, where, kind), df in source._STAGED.items() if where == folder}
    assert staged["marked-places"] == ["City", "Date", "AQI", "is_test"]
    assert staged["classes"] == ["AQI_Bucket", "by_pm2_5", "by_pm10"]


def test_correlation_of_a_complete_table_needs_plain_sums(spark, cleaned):
    text = plan(correlation_matrix(cleaned, CORRELATED))
    assert "covar" not in text and text.count("Exchange") == 2


@pytest.mark.parametrize("shift", [0.0, -7e5, 3e9])
def test_correlation_of_a_complete_table(spark, shift):
    df = spark.range(4_000).select((F.rand(1) + shift).alias("a"), (F.rand(2) * 1e-6).alias("b"), F.lit(2.0).alias("c"))
    df = df.withColumn("d", F.col("a") - shift + F.col("b") * 1e6).cache()
    found = {(r["row"], r["col"]): r["value"] for r in correlation_matrix(df, list("abcd")).collect()}
    for x in "abd":
        assert found[x, "c"] is None and found["c", x] is None
        for y in "abd":
            assert abs(found[x, y] - df.agg(F.corr(x, y)).first()[0]) < 1e-7
