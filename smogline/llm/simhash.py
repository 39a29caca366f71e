"""Document fingerprints (3): SimHash over word shingles, and all pairs within a Hamming radius.

Every shingle's 128 hash bits vote, with the shingle's weight, for or against a
bit of the fingerprint. Fingerprints within the radius are found by tables of
permuted blocks: among radius + 1 blocks one is equal, and among radius + 1
parts of the other blocks again one, so every close pair shares one of
(radius + 1)² keys of a block and a part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.common import parts_for, texts, words_of
from smogline.llm.shingles import mix, rolling

BITS = 128
#: Text that one sorted bucket of neighbouring documents holds, on average.
BUCKET_BYTES = 32 << 20


def fingerprint(text: str, k: int = 5) -> bytes:
    """16 bytes. A shingle that occurs n times votes with weight 1 + ln n; without words all bits are 0."""
    runs = rolling(words_of(text), k)
    if not len(runs):
        return bytes(BITS // 8)
    terms, counts = np.unique(runs, return_counts=True)
    weights = (1 + np.log(counts)).astype(np.float32)
    votes = np.zeros(BITS, dtype=np.float64)
    for at in range(0, len(terms), 4096):  # very long texts in steps
        t = terms[at : at + 4096]
        bits = np.unpackbits(np.stack([t, mix(t ^ np.uint64(0x5851F42D4C957F2D))], axis=1).view(np.uint8), axis=1)
        w = weights[at : at + 4096]
        votes += 2.0 * (w @ bits.astype(np.float32)) - w.sum()
    return np.packbits(votes > 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal bits."""
    return 1 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / BITS


def fingerprints(docs: DataFrame, k: int = 5) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hexadecimal) per document; a missing text is empty."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [fingerprint(t, k).hex() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fingerprint": found})

    return texts(docs).mapInPandas(score, "doc_id long, fingerprint string")


def within_radius(prints: DataFrame, radius: int = 3) -> DataFrame:
    """All pairs ``a < b`` of different fingerprints (hexadecimal) with ``distance`` at most the radius.

    Equal fingerprints are one row before the tables are built.
    """
    blocks = radius + 1
    distinct = prints.select("fingerprint").where("fingerprint is not null").distinct()
    bits = F.concat(*[F.lpad(F.conv(F.substring("fingerprint", 8 * j + 1, 8), 16, 2), 32, "0") for j in range(BITS // 32)])
    size = BITS // blocks
    keys = []
    for block in range(blocks):
        rest = [c for c in range(BITS) if not block * size <= c < (block + 1) * size]
        step = -(-len(rest) // blocks)
        others = F.concat(F.substring("bits", 1, block * size), F.substring("bits", (block + 1) * size + 1, BITS))
        for part in range(blocks):
            keys.append(F.xxhash64(F.lit(block * blocks + part), F.substring("bits", block * size + 1, size), F.substring(others, part * step + 1, step)))
    rows = distinct.withColumn("bits", bits).select("fingerprint", F.explode(F.array(*keys)).alias("key"))
    x, y = rows.alias("x"), rows.alias("y")
    word = lambda side, j: F.conv(F.substring(f"{side}.fingerprint", 8 * j + 1, 8), 16, 10).cast("long")
    distance = sum((F.bit_count(word("x", j).bitwiseXOR(word("y", j))) for j in range(BITS // 32)), F.lit(0))
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.fingerprint") < F.col("y.fingerprint")) & (distance <= radius))
    return pairs.select(F.col("x.fingerprint").alias("a"), F.col("y.fingerprint").alias("b"), distance.alias("distance")).distinct()


def edited_fingerprints(docs: DataFrame, k: int = 5) -> DataFrame:
    """Fingerprint of every text and of its edited text, with their likenesses.

    The edited text has its last half replaced from the start of the next
    document, in descending ``doc_id`` (missing ones last, equal ones by text);
    after the last comes the first. Documents are sorted in ranges; a range also
    gets the first document of the next one. A single document is its own next;
    an empty table gives an empty table.
    """
    docs = texts(docs).withColumn("place", F.coalesce("doc_id", F.lit(-(2**63))))
    ranges = parts_for(docs, "text", BUCKET_BYTES)
    cuts = sorted(set(docs.approxQuantile("place", [i / ranges for i in range(1, ranges)], 0.2 / ranges))) if ranges > 1 else []
    spark = docs.sparkSession
    bounds = F.array(*[F.lit(int(c)) for c in cuts]) if cuts else None
    # number of cuts at or below the place, by the sorted array
    bucket = F.size(F.filter(bounds, lambda c: c <= F.col("place"))) if cuts else F.lit(0)
    docs = docs.withColumn("bucket", bucket.cast("int"))
    heads = docs.groupBy("bucket").agg(F.max("place").alias("place"))  # a row per range
    order = Window.orderBy("bucket")
    last = heads.agg(F.max("bucket").alias("last"))
    heads = heads.select("bucket", "place", F.lead("bucket").over(order).alias("above"), F.min("bucket").over(order).alias("lowest"))
    heads = heads.select("bucket", "place", F.coalesce("above", "lowest").alias("also"))
    copies = docs.join(F.broadcast(heads), ["bucket", "place"], "left")
    own = F.struct(F.col("bucket"), F.lit(0).alias("borrowed"))
    borrowed = F.struct(F.col("also").alias("bucket"), F.lit(1).alias("borrowed"))
    where = F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, borrowed))
    rows = copies.select("doc_id", "place", "text", F.explode(where).alias("at")).select("doc_id", "place", "text", "at.*")
    ordered = Window.partitionBy("bucket").orderBy("borrowed", F.desc("place"), "text")
    half = F.floor(F.length("text") / 2).cast("int")
    following = F.lead("text").over(ordered)
    rows = rows.withColumn("n", F.length("text")).select(
        "doc_id", "place", "bucket", "borrowed", "text", F.row_number().over(ordered).alias("row"), following.substr(F.lit(1), half).alias("tail")
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, tail, extra in zip(batch["text"], batch["tail"], batch["borrowed"]):
                own = fingerprint(text, k)
                n = len(text)
                if extra:
                    out.append((n, None, own.hex(), None, None))
                    continue
                edited = text[: n - n // 2] + (tail or "")
                other = fingerprint(edited, k) if edited != text else own
                out.append((n, hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), own.hex(), other.hex(), likeness(own, other)))
            found = pd.DataFrame(out, columns=["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited"])
            for name in ("doc_id", "bucket", "borrowed", "row"):
                found[name] = batch[name].astype("Int64").to_numpy(dtype=object) if name == "doc_id" else batch[name].to_numpy()
            found["doc_id"] = found["doc_id"].astype("Int64")
            yield found

    schema = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, doc_id long, bucket int, borrowed int, row int"
    scored = rows.mapInPandas(score, schema)
    by_row = Window.partitionBy("bucket").orderBy("row")
    part = lambda c, j: F.conv(F.substring(c, 8 * j + 1, 8), 16, 10).cast("long")
    differ = sum((F.bit_count(part("fingerprint", j).bitwiseXOR(part("next_print", j))) for j in range(BITS // 32)), F.lit(0))
    return (
        scored.withColumn("next_print", F.lead("fingerprint").over(by_row))
        .where("borrowed = 0")
        .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", (1 - differ / F.lit(float(BITS))).alias("near_next"))
    )
