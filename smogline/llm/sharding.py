"""Sharding (5): a two-pass external shuffle into shards of equal row counts.

Pass one scatters records by a seeded hash of their position into buckets that
fit in a task's memory. Pass two shuffles each bucket (Fisher-Yates, Spark's
``shuffle``) and writes it. A record's global place is its bucket's start plus
its place in the bucket, and shards are equal ranges of places, so a shard is a
run of neighbouring buckets and needs no further exchange.

DataFrame functions only. The scatter hashes positions, not contents, so copies
of one record, however many, are spread over all buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.common import parts_for, texts
from smogline.session import stage

#: Text that one bucket holds, on average.
BUCKET_BYTES = 12 << 20


def shuffled_buckets(docs: DataFrame, seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Written table of ``doc_id``, ``text``, ``bucket``, ``place``: every bucket in random order."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    buckets = parts_for(docs, "text", bucket_bytes, most=1_000_000)
    scatter = F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), "doc_id"), F.lit(buckets)).cast("int")
    record = F.struct(F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"), "doc_id", "text")
    # sorted first, so that a bucket made again after a loss is shuffled from the same order
    order = F.shuffle(F.array_sort(F.collect_list(record)), F.lit(seed))
    dealt = docs.withColumn("bucket", scatter).repartition(buckets, "bucket")
    mixed = dealt.groupBy("bucket").agg(order.alias("records")).select("bucket", F.posexplode("records").alias("place", "r"))
    return stage(mixed.select("r.doc_id", "r.text", "bucket", F.col("place").cast("long").alias("place")), "buckets")


def assign_shards(shuffled: DataFrame, shards: int = 24) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0); counts differ by one at most.

    With fewer records than shards the last shards stay empty.
    """
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = shuffled.groupBy("bucket").agg(F.count("*").alias("n"))  # a row per bucket, a million at most
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy()).alias("total"))
    at = F.col("first") + F.col("place")
    share, more = F.expr(f"total div {shards}"), F.expr(f"total % {shards}")
    # the first `more` shards hold share + 1 records, the others share
    large = more * (share + 1)
    shard = F.when(at < large, F.expr(f"at div (total div {shards} + 1)")).otherwise(more + F.expr(f"(at - (total % {shards}) * (total div {shards} + 1)) div greatest(total div {shards}, 1)"))
    slot = F.when(at < large, F.expr(f"at % (total div {shards} + 1)")).otherwise(F.expr(f"(at - (total % {shards}) * (total div {shards} + 1)) % greatest(total div {shards}, 1)"))
    placed = shuffled.join(F.broadcast(starts), "bucket").withColumn("at", at)  # else the texts are shuffled once more
    return placed.withColumns({"shard": shard.cast("int"), "slot": slot.cast("long")}).drop("first", "total", "at", "bucket", "place")


def write_shards(placed: DataFrame, folder: str) -> None:
    """One folder per shard; rows keep their ``slot``."""
    placed.write.mode("overwrite").partitionBy("shard").parquet(folder)


def shard_digest(docs: DataFrame, shards: int = 24, seed: int = 42) -> DataFrame:
    """Size, checksum and place of every document after the shuffle."""
    placed = assign_shards(shuffled_buckets(docs, seed), shards)
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
