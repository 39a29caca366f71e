"""Exact dedup (11): composable polynomial fingerprints, then chunkwise comparison of texts with equal ones.

A text's fingerprint is its length in bytes and the values of its bytes, read as
a polynomial, at a fixed place modulo two primes. Values of neighbouring parts
combine: the left one is shifted by the length of the right one and added. So
the pieces of a long text are hashed as rows of their own, wherever Spark puts
them, and each piece's value, shifted by the bytes behind it, is summed.

Fingerprints are counted first, without texts. Only texts whose fingerprint
occurs again are sent, to buckets of a fingerprint; a fingerprint with many rows
has many buckets. In a bucket the texts stream past those that came before and
differ from each other (one, but for a collision) and are compared chunk by
chunk. The first text of each class goes on to the next level, where buckets of
one fingerprint meet, until a fingerprint has one bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import reachable, texts
from smogline.session import stage

#: Primes below 2^31 and the places at which the polynomials are taken.
PRIMES = (2147483647, 2147483629)
PLACES = (1_442_695_041, 920_419_823)
#: Bytes that are hashed or compared at once; sums stay below 2^64.
CHUNK = 1 << 15
#: Texts of more bytes are hashed by pieces of this size, dealt over the cluster.
PIECE = 1 << 20
#: Rows, and bytes, of one fingerprint that one bucket takes, on average.
BUCKET_ROWS, BUCKET_BYTES = 2_000, 64 << 20

PRINT = ["n_bytes", "h1", "h2"]


@lru_cache(4)
def _powers(prime: int, place: int) -> np.ndarray:
    """place^(CHUNK - 1), ..., place, 1 modulo the prime."""
    powers = np.ones(1, np.uint64)
    while len(powers) < CHUNK:
        step = pow(place, len(powers), prime)
        powers = np.concatenate([powers, powers * np.uint64(step) % np.uint64(prime)])
    return powers[:CHUNK][::-1].copy()


def combine(left: int, right: int, right_bytes: int, k: int) -> int:
    """Value of two neighbouring parts from theirs."""
    return (left * pow(PLACES[k], right_bytes, PRIMES[k]) + right) % PRIMES[k]


def polynomial(data: bytes) -> tuple[int, int]:
    """Values of the bytes, each plus one, modulo both primes."""
    values = [0, 0]
    for at in range(0, len(data), CHUNK):
        part = np.frombuffer(data, np.uint8, min(CHUNK, len(data) - at), at).astype(np.uint64) + np.uint64(1)
        for k in (0, 1):
            own = int((part * _powers(PRIMES[k], PLACES[k])[CHUNK - len(part) :]).sum() % np.uint64(PRIMES[k]))
            values[k] = combine(values[k], own, len(part), k)
    return values[0], values[1]


def _print_of(text_col: str) -> Column:
    """The fingerprint of a whole text, evaluated once per row wherever a plan uses its parts."""

    @F.pandas_udf("n_bytes long, h1 long, h2 long")
    def whole(batch: pd.Series) -> pd.DataFrame:
        found = []
        for one in batch:
            data = one.encode("utf-8", "replace")
            found.append((len(data), *polynomial(data)))
        return pd.DataFrame(found, columns=PRINT)

    return whole.asNondeterministic()(text_col)


def fingerprints(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """``row``, ``doc_id``, fingerprint and ``sha`` of every row of ``row``, ``doc_id``, ``text``.

    Texts of more than ``piece`` bytes are cut; their pieces are hashed apart
    and combined by a sum.
    """
    kept = ["row", "doc_id"]
    size, sha = F.octet_length("text").cast("long"), F.unhex(F.sha2("text", 256)).alias("sha")
    short = rows.where(size <= piece).select(*kept, _print_of("text").alias("p"), sha).select(*kept, "p.*", "sha")
    whole = rows.where(size > piece).select(*kept, size.alias("n_bytes"), sha, F.encode("text", "utf-8").alias("data"))
    numbers = F.expr(f"sequence(0L, (n_bytes - 1) div {piece})")
    part = F.col("data").substr((F.col("no") * piece + 1).cast("int"), F.lit(piece))
    behind = F.greatest(F.col("n_bytes") - (F.col("no") + 1) * piece, F.lit(0).cast("long"))
    pieces = whole.select(*kept, "n_bytes", "sha", "data", F.explode(numbers).alias("no"))
    pieces = pieces.select(*kept, "n_bytes", "sha", "no", behind.alias("behind"), part.alias("part")).repartition("row", "no")

    @F.pandas_udf("h1 long, h2 long")
    def shifted(part: pd.Series, behind: pd.Series) -> pd.DataFrame:
        found = []
        for data, n in zip(part, behind):
            values = polynomial(bytes(data))
            found.append(tuple(combine(values[k], 0, int(n), k) for k in (0, 1)))
        return pd.DataFrame(found, columns=PRINT[1:])

    values = pieces.select(*kept, "n_bytes", "sha", shifted.asNondeterministic()("part", "behind").alias("p"))
    long = values.groupBy(*kept, "n_bytes", "sha").agg(
        *[(F.sum(f"p.{h}") % p).alias(h) for h, p in zip(PRINT[1:], PRIMES)]
    )
    return short.unionByName(long)


def same(a: str, b: str) -> bool:
    """Whether two texts are identical, chunk by chunk up to the first difference."""
    return len(a) == len(b) and all(a[at : at + CHUNK] == b[at : at + CHUNK] for at in range(0, len(a), CHUNK))


def _salts(size: int, level: int) -> Column:
    """Buckets of a fingerprint with ``n`` rows; they take more rows from level to level, so the levels end."""
    most = size << (2 * level)
    by_bytes = F.ceil(F.col("n") * F.col("n_bytes") / (BUCKET_BYTES << (2 * level)))
    return F.greatest(F.ceil(F.col("n") / most), by_bytes, F.lit(1)).cast("long").alias("salts")


MEMBER = ["row", "doc_id", "sha"]


def _compared(rows: DataFrame) -> DataFrame:
    """``leader`` of each row, the first with its text in its bucket; a leader keeps its text if it has to meet others."""
    bucket = [*PRINT, "salt"]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts")))
    dealt = salted.repartition(*bucket).sortWithinPartitions(*bucket, "row")
    columns = [*MEMBER, "leader", "text"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, leaders = None, []
        for batch in batches:
            found = []
            for row, text, salts, *key in zip(*(batch[c] for c in ("row", "text", "salts", *bucket))):
                if key != current:
                    current, leaders = key, []
                leader = next((r for r, t in leaders if same(t, text)), None)
                if leader is None:
                    leaders.append((row, text))
                    found.append((row, text if salts > 1 else None))
                else:
                    found.append((leader, None))
            out = pd.DataFrame(found, columns=["leader", "text"])
            out["row"], out["doc_id"], out["sha"] = batch["row"], batch["doc_id"].astype("Int64"), batch["sha"]
            yield out[columns]

    return dealt.mapInPandas(compare, "row long, doc_id long, sha binary, leader long, text string")


def classes(rows: DataFrame, piece: int = PIECE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``row``, ``doc_id``, ``sha``, ``keep_id``, ``keep_row``, ``group_size`` for rows of ``row``, ``doc_id``, ``text``.

    Of rows with equal texts the one with the largest id stays; one without id
    only if none has an id; of equal ids the one with the largest ``row``.
    """
    prints = stage(fingerprints(rows, piece), "prints")
    several = prints.groupBy(*PRINT).agg(F.count("*").alias("n")).where("n > 1")
    several = stage(several.select(*PRINT, _salts(bucket_rows, 0)), "several")  # joined by its real size

    alone = prints.join(several, PRINT, "left_anti")
    alone = alone.select(*MEMBER, F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("group_size"))

    suspects = rows.select("row", "doc_id", "text", _print_of("text").alias("p")).select("row", "doc_id", "text", "p.*")
    suspects = suspects.join(several, PRINT).withColumn("sha", F.unhex(F.sha2("text", 256)))
    members = stage(_compared(suspects), "classes")
    found, level = members.drop("text"), 0
    leaders = members.where("text is not null").drop("leader")
    while not leaders.isEmpty():  # a row per bucket and different text
        level += 1
        leaders = leaders.select(*MEMBER, "text", _print_of("text").alias("p")).select(*MEMBER, "text", "p.*")
        several = leaders.groupBy(*PRINT).agg(F.count("*").alias("n")).select(*PRINT, _salts(bucket_rows, level))
        above = stage(_compared(leaders.join(stage(several, "several"), PRINT)), "classes")
        up = above.select(F.col("row").alias("leader"), F.col("leader").alias("above"))
        found = found.join(up, "leader", "left").select(*MEMBER, F.coalesce("above", "leader").alias("leader"))
        leaders = above.where("text is not null").drop("leader")
    best = F.max(F.struct("doc_id", "row")).alias("best")
    kept = stage(found.groupBy("leader").agg(best, F.count("*").alias("group_size")), "kept")
    more = found.join(kept, "leader")
    more = more.select(*MEMBER, F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")
    return alone.unionByName(more)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, of equal texts only the row with the largest id, with all their columns.

    A missing text equals an empty one. Of equal ids one row stays. The table is
    written once, with a number per row, so that rows are told apart.
    """
    number = "row"
    while number in docs.columns:
        number += "_"
    reachable(docs.sparkSession)
    docs = stage(docs.withColumn(number, F.monotonically_increasing_id()), "documents")
    rows = docs.select(
        F.col(number).alias("row"), docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )
    stays = classes(rows).where("row = keep_row").select(F.col("row").alias(number))
    return docs.join(stays, number, "left_semi").drop(number)


def dedup_digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of every row.

    A missing text is empty. Of equal texts the row with the largest id stays, a
    row without id only if no other has one; of equal ids one row is kept. An
    empty table gives an empty table; other columns are not read.
    """
    found = classes(texts(docs).withColumn("row", F.monotonically_increasing_id()))
    return found.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )
