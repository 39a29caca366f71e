"""N-gram Jaccard join (8): documents whose sets of word shingles are similar.

Grouped prefix join. A document's shingles are ordered by rarity; two similar
sets must share one of their first shingles (the prefix). Equal sets collapse
to one member, members with equal prefix and size to one group, and groups are
compared by the size and position filters before members are verified exactly.

Rarity comes from a sketch of all documents' shingles with a fixed number of
slots. Any order that is the same for all documents gives the same result; the
sketch only keeps very common shingles out of the prefixes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.common import stage, texts, words_of
from smogline.llm.components import linked
from smogline.llm.shingles import digest, distinct, rolling

#: Slots of the rarity sketch and of the map of wanted documents: 4 MB and 2 MB at any size of the input.
SLOTS = 1 << 22
WANTED = 1 << 24
#: Odd factors that permute hashes; a set's smallest product under each is one of its least hashes.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9FB21C651E98DF25, 0xD1342543DE82EF95], dtype=np.uint64)
#: Bins of the widest sketch.
WIDEST = 1 << 15
#: Different sets per salt, so that a chain of equal least hashes stays bounded.
SALTED = 200_000
#: Shingles counted before a task hands on its heavy slots.
COUNTED = 2_000_000


def common_slots(docs: DataFrame, k: int) -> np.ndarray:
    """Level per slot: 0 for ordinary shingles, higher for slots that documents share often."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some, seen = [], 0

        def heavy() -> pd.DataFrame:
            slots, n = np.unique(np.concatenate([np.empty(0, np.uint32), *some]), return_counts=True)
            often = n > 8 + 4 * seen // SLOTS
            return pd.DataFrame({"slot": slots[often].astype(np.int32), "n": n[often].astype(np.int64)})

        for batch in batches:
            for text in batch["text"]:
                some.append((rolling(words_of(text), k) & np.uint64(SLOTS - 1)).astype(np.uint32))
                seen += len(some[-1])
                if seen >= COUNTED:
                    yield heavy()
                    some, seen = [], 0
        yield heavy()

    found = docs.select("text").mapInPandas(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    level = np.zeros(SLOTS, dtype=np.uint8)
    rows = found.select("slot", F.floor(F.log2("n")).cast("int").alias("level")).toPandas()  # SLOTS rows at most
    level[rows["slot"].to_numpy(dtype=np.int64)] = np.clip(rows["level"].to_numpy(dtype=np.int64), 1, 255)
    return level


def sketch_of(s: np.ndarray) -> np.ndarray:
    """Whether bins of the hashes hold an odd number: 512 bins first, then for more hashes a power of two that is at least their number.

    A bin in which two sketches differ holds a hash that only one set has. Halves
    of a sketch fold into the next smaller one, so different widths compare.
    """
    wide = min(WIDEST, max(512, 1 << (len(s) - 1).bit_length()))
    odd = np.bincount(((s >> np.uint64(40)) & np.uint64(wide - 1)).astype(np.int64), minlength=wide) & 1
    folded = odd.reshape(-1, 512).sum(axis=0) & 1
    return np.packbits(np.concatenate([folded, odd] if wide > 512 else [folded]).astype(np.uint8)).view(np.int64)


def sets_of(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per document the size of its set, a digest of the set and of its prefix; the prefix with its first document in a task.

    ``sketch`` is of the whole set, once per set and task. ``least`` has three bytes
    of its least hash under each of the FACTORS, once per set and task.
    """
    level = docs.sparkSession.sparkContext.broadcast(common_slots(docs, k))  # SLOTS bytes

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done = set()  # copies hand on prefix and sketch once a task
        for batch in batches:
            rows = []
            for text in batch["text"]:
                s = distinct(rolling(words_of(text), k))
                n = len(s)
                if n:
                    rank = level.value[(s & np.uint64(SLOTS - 1)).astype(np.int64)]
                    size = n - -(-percent * n // 100) + 1
                    prefix = s[np.argsort(rank, kind="stable")[:size]] if rank.any() else s[:size]
                    group = digest(prefix)
                    item = digest(s)
                    sketch = sketch_of(s) if item not in done else np.empty(0, dtype=np.int64)
                    least = b"" if item in done else b"".join(int((s * f).min()).to_bytes(8, "little")[:3] for f in FACTORS)
                    rows.append((n, item, sketch, least, group, prefix[: 0 if (group, n) in done else size].view(np.int64)))
                    done |= {(group, n), item}
                else:
                    rows.append((0, 0, np.empty(0, dtype=np.int64), b"", 0, np.empty(0, dtype=np.int64)))
            out = pd.DataFrame(rows, columns=["n_shingles", "item", "sketch", "least", "prefix_digest", "prefix"], index=batch.index)
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield out

    return docs.mapInPandas(describe, "doc_id long, n_shingles long, item long, sketch array<long>, least binary, prefix_digest long, prefix array<long>")


def marked(rows: DataFrame, value: Column) -> np.ndarray:
    """Bit map of the slots of a number in all rows, WANTED bits in all."""
    width = 1 << 15
    slot = F.pmod(value, F.lit(WANTED))
    parts = rows.groupBy(F.floor(slot / width).cast("int").alias("part")).agg(F.bitmap_construct_agg(F.pmod(slot, F.lit(width))).alias("bits"))
    bits = np.zeros(WANTED // 8, dtype=np.uint8)
    for r in parts.collect():  # WANTED / width rows of 4 KB at most
        bits[r["part"] * 4096 : (r["part"] + 1) * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)[:4096]
    return bits


def fetch_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``item`` and its sorted shingles for the wanted items (``item``, ``doc_id`` of one document with that set), once per task.

    Bit maps of the wanted documents and items keep nearly all others out, so
    that no set is shuffled here; a few sets that nobody wants may come along.
    """
    number = F.xxhash64("doc_id")
    shared = docs.sparkSession.sparkContext.broadcast((marked(wanted, number), marked(wanted, F.col("item"))))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_doc, by_item = shared.value
        done = set()
        for batch in batches:
            s = batch["slot"].to_numpy(dtype=np.int64)
            rows = []
            for text in batch["text"][(by_doc[s >> 3] >> (s & 7)) & 1 == 1]:
                found = distinct(rolling(words_of(text), k))
                item = digest(found)
                if item not in done and (by_item[item % WANTED >> 3] >> (item % WANTED & 7)) & 1:
                    rows.append((item, found.tobytes()))
                    done.add(item)
            if rows:
                yield pd.DataFrame(rows, columns=["item", "shingles"])

    return docs.select("text", F.pmod(number, F.lit(WANTED)).alias("slot")).mapInPandas(fetch, "item long, shingles binary")


def near(percent: int, wide: bool) -> Callable[[str, str], Column]:
    """Necessary condition on ``size`` and ``sketch`` of two sets; all bins are compared if ``wide``, else the first 512.

    Every bit in which sketches differ is an element that only one set has; sizes alone may tell, too.
    """

    def condition(x: str, y: str) -> Column:
        nx, ny = F.col(f"{x}.size"), F.col(f"{y}.size")
        sx, sy = F.col(f"{x}.sketch"), F.col(f"{y}.sketch")
        most = F.lit(100 - percent) * (nx + ny)
        bits = [F.bit_count(sx[i].bitwiseXOR(sy[i])) for i in range(8)]
        may = (F.lit(100) * F.least(nx, ny) >= F.lit(percent) * F.greatest(nx, ny)) & (F.lit(100 + percent) * sum(bits[1:], bits[0]) <= most)
        if not wide:
            return may
        words = F.least(F.size(sx), F.size(sy)) - 8  # sizes so near have at most twice as many
        word = lambda s, i: F.coalesce(F.get(s, 8 + i), F.lit(0)).bitwiseXOR(F.coalesce(F.get(s, 8 + words + i), F.lit(0)))
        differing = F.aggregate(F.sequence(F.lit(0), words - 1), F.lit(0), lambda n, i: n + F.bit_count(word(sx, i).bitwiseXOR(word(sy, i))))
        return may & (F.lit(100 + percent) * F.when(words > 0, differing).otherwise(F.lit(0)) <= most)

    return condition


def similar(docs: DataFrame, members: DataFrame, sketches: DataFrame, k: int, percent: int):
    """Keep the pairs whose sets have at least that similarity.

    Only the sets of pairs whose sketches allow it are fetched and intersected.
    """

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"]):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[keep, ["a", "b"]]

    def verify(pairs: DataFrame) -> DataFrame:
        x, y = sketches.alias("x"), sketches.alias("y")
        likely = pairs.join(x, F.col("a") == F.col("x.item"), "left").join(y, F.col("b") == F.col("y.item"), "left")
        pairs = stage(likely.where(F.coalesce(near(percent, wide=True)("x", "y"), F.lit(True))).select("a", "b"), "near")
        items = pairs.select(F.explode(F.array("a", "b")).alias("item")).distinct()
        sets = stage(fetch_sets(docs, items.join(members.select("item", "doc_id"), "item"), k), "wanted")
        sets = sets.groupBy("item").agg(F.first("shingles").alias("shingles"))  # shuffled once for both joins
        a = sets.select(F.col("item").alias("a"), F.col("shingles").alias("x"))
        b = sets.select(F.col("item").alias("b"), F.col("shingles").alias("y"))
        return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInPandas(check, "a long, b long")

    return verify


def neighbours(full: DataFrame, n_sets: int) -> DataFrame:
    """Pairs of sets that follow each other among those with an equal least hash; a few per set.

    For each factor the sets stand in the order of their least hashes from it on, so
    neighbours agree in as many as possible: of a large group of near copies those
    closest to each other, whatever other documents share its frequent shingles.
    Each factor salts the sets anew, so the chains of one cross those of another. The
    next three are taken where at least half of the least hashes agree: this only
    chooses what is tried first.
    """
    sets = full.where("length(least) > 0").groupBy("item").agg(F.first("least").alias("least"))
    factor = F.explode(F.sequence(F.lit(0), F.lit(len(FACTORS) - 1))).alias("factor")
    rows = sets.select("item", "least", factor).withColumn("least", F.expr("concat(substring(least, 3 * factor + 1), substring(least, 1, 3 * factor))"))
    salt = F.pmod(F.xxhash64("item", "factor"), F.lit(n_sets // SALTED + 1))
    chain = Window.partitionBy("factor", F.substring("least", 1, 3), salt).orderBy("least", "item")
    next_ones = F.array(*[F.lead(F.struct("item", "least"), j).over(chain) for j in (1, 2, 3)])
    rows = rows.select("item", "least", next_ones.alias("next")).select("item", "least", F.explode("next").alias("next"))
    agreed = sum(F.expr(f"int(substring(least, {3 * j + 1}, 3) = substring(next.least, {3 * j + 1}, 3))") for j in range(len(FACTORS)))
    rows = rows.where(agreed >= len(FACTORS) // 2).select("item", F.col("next.item").alias("other"))
    return rows.select(F.least("item", "other").alias("a"), F.greatest("item", "other").alias("b"))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` per document.

    A text without words, an empty or missing one has no shingles and is alone.
    Equal sets are always linked; repeated rows stay rows. A missing ``doc_id``
    gets the component of its links, missing if they have none. Sets are told
    apart by 64-bit digests, shingles by 64-bit hashes.
    """
    docs = texts(docs)
    described = stage(sets_of(docs, k, percent), "sets")
    full = described.where("n_shingles > 0")
    group = F.xxhash64("prefix_digest", "n_shingles").alias("g")
    # equal sets are one member: the smallest document stands for it
    members = stage(full.groupBy("item", group, "n_shingles").agg(F.min("doc_id").alias("doc_id")), "members")
    # a key of one group alone links nothing, and most keys are of one group
    in_key = Window.partitionBy("key")
    keyed = full.where("size(prefix) > 0").select(group, F.posexplode("prefix").alias("pos", "key"))
    shared = keyed.withColumns({"lo": F.min("g").over(in_key), "hi": F.max("g").over(in_key)}).where("lo <> hi").select("key", "g", "pos").distinct()
    postings = shared.join(members, "g").select("key", "item", F.col("n_shingles").cast("int").alias("n"), "pos")
    # members of one group have all prefix shingles in common: one key, their group, is enough
    sizes = members.groupBy("g").agg(F.count("*").alias("m"))
    inside = members.join(sizes.where("m > 1").select("g"), "g")
    postings = postings.unionByName(
        inside.select(F.col("g").alias("key"), "item", F.col("n_shingles").cast("int").alias("n"), F.lit(0).alias("pos"))
    )

    def may_link(x: str, y: str) -> Column:
        nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
        px, py = F.col(f"{x}.pos"), F.col(f"{y}.pos")
        overlap = F.least(nx - px, ny - py)
        return (
            (F.lit(100) * F.least(nx, ny) >= F.lit(percent) * F.greatest(nx, ny))
            & (F.lit(100 + percent) * overlap >= F.lit(percent) * (nx + ny))
        )

    sketches = stage(full.where("size(sketch) > 0").groupBy("item").agg(F.first("sketch").alias("sketch"), F.first("n_shingles").alias("size")), "sketches")
    narrow = sketches.select("item", F.slice("sketch", 1, 8).alias("sketch"), "size")
    labels = linked(postings, similar(docs, members, sketches, k, percent), may_link, ["n"], neighbours(full, members.count()), narrow, near(percent, wide=False))
    label = members.join(labels, "item", "left").select("item", "doc_id", F.coalesce("label", "item").alias("label"))
    lowest = label.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    found = label.join(lowest, "label").select("item", "component_id")
    return (
        described.select("doc_id", "n_shingles", "item").join(found, "item", "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    )
