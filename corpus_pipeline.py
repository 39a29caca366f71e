"""A corpus pipeline: toxic documents go, repeated lines go, near copies go, the rest is packed.

STAGES lists the stages in order. Each takes the session, the documents that
its predecessor kept and the folder of the given tables. All but the last
return the columns of the documents; ``run`` writes each result to the shared
folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.llm.common import fresh, table
from smogline.llm.jaccard import jaccard_components
from smogline.llm.linededup import dedup_lines
from smogline.llm.packing import pack, pieces_of
from smogline.llm.registry import tokenizer_path
from smogline.llm.toxicity import score, train
from smogline.session import stage


#: Documents that a Python worker gets at once, and bytes of them.
BATCH, BATCH_BYTES = 2_000, 4 << 20


#: Workers give freed arrays back to the system instead of keeping them for the next stage.
FREED = {
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(1 << 20),
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def small_batches(spark: SparkSession) -> None:
    """Make the session's Arrow batches smaller, and let workers keep less: rows are whole documents.

    Every stage asks for it, as each may be run alone: workers live through all
    stages and would keep what their largest batch took.
    """
    batch, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(batch, str(min(int(spark.conf.get(batch)), BATCH)))
    spark.conf.set(size, str(BATCH_BYTES))
    for key, value in FREED.items():
        spark.sparkContext.environment.setdefault(key, value)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half; the network learns from their labelled rows.

    Missing and empty texts are scored as a blank word; repeated rows stay; all
    stay where there is nothing to learn from.
    """
    small_batches(spark)
    name = fresh(docs, "toxic_score")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, name).where(F.col(name) < 0.5).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document has, short ones included; ``n_chars`` follows the text.

    A document that loses lines and keeps nothing but blanks goes; documents
    that lose nothing stay as they are, empty ones too.
    """
    small_batches(spark)
    n_lines, n_removed = fresh(docs, "n_lines"), fresh(docs, "n_removed")
    found = dedup_lines(docs, exact_chars=1, counts=(n_lines, n_removed))
    rest = F.regexp_replace(F.coalesce("text", F.lit("")), r"\s", "")
    found = found.where((F.col(n_removed) == 0) | (rest != ""))
    length = {"n_chars": F.when(F.col(n_removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")}
    return found.withColumns(length if "n_chars" in docs.columns else {}).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar rows one: of the smallest id the longest text; missing ids come last.

    Rows are compared by their texts, whatever their ids; texts without words stay.
    """
    small_batches(spark)
    columns, row = docs.columns, fresh(docs, "row")
    docs = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    parts = jaccard_components(docs.select(F.col(row).alias("doc_id"), "text"))
    parts = stage(parts.select(F.col("doc_id").alias("row"), "n_shingles", "component_id"), "parts")
    number = F.col("doc_id").cast("long")
    order = F.struct(number.isNull(), number, -F.length("text"), F.xxhash64("text"), F.col(row).alias("row"))
    found = docs.select(F.col(row).alias("row"), order.alias("place")).join(parts.where("n_shingles > 0"), "row")
    first = found.groupBy("component_id").agg(F.min("place").alias("place")).select(F.col("place.row").alias(row))
    stays = first.unionByName(parts.where("n_shingles = 0").select(F.col("row").alias(row)))
    return docs.join(stays, row, "left_semi").select(*columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their sequences; missing and empty texts are an end id each."""
    small_batches(spark)
    return pack(pieces_of(docs, tokenizer_path("word_bpe_49k.json")))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_copies", near_copies), ("packing", packing)]

#: The network and the program over patterns are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE = {"pipeline": run}
