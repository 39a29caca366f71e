"""Line dedup (6): a segment-partition edit join over all lines.

Two lines within ``limit`` edits share one of ``limit + 1`` segments of the
shorter line, at nearly the same place of the longer one. So every line gives
the keys of its own segments, and of the substrings that could equal a segment
of a line of its length or up to ``limit`` shorter. Lines that share a key are
verified by a banded bit-parallel edit distance, linked lines form components,
and of each component the first line of the smallest document stays.

Lines of fewer than ``min_chars`` characters are compared for exact copies only,
and those of fewer than ``exact_chars``, or of blanks alone, always stay.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from smogline.llm.common import fresh, texts
from smogline.llm.components import linked
from smogline.session import stage

MIN_CHARS = 48
LIMIT = 2
#: Classes of characters (code point modulo this) whose counts two lines are compared by.
CLASSES = 16
#: Bits of the map of wanted lines: 2 MB at any size of the input.
WANTED = 1 << 24


def within(a: str, b: str, limit: int) -> bool:
    """Whether the edit distance is at most ``limit``.

    Bit ``j`` of ``rows[e]`` says that the first ``at - limit + j`` characters of
    ``a`` become the first ``at`` of ``b`` with at most ``e`` edits, so each row
    is a band of 2 * limit + 1 bits around the diagonal.
    """
    if abs(len(a) - len(b)) > limit:
        return False
    start = len(os.path.commonprefix([a, b]))
    a, b = a[start:], b[start:]
    end = len(os.path.commonprefix([a[::-1], b[::-1]]))
    a, b = a[: len(a) - end], b[: len(b) - end]
    m, n, full = len(a), len(b), (1 << (2 * limit + 1)) - 1
    rows = [(((1 << (e + 1)) - 1) << limit) & full for e in range(limit + 1)]
    for at, c in enumerate(b):
        equal = 0
        for j in range(max(0, limit - at), min(2 * limit, m - 1 - at + limit) + 1):
            if a[at - limit + j] == c:
                equal |= 1 << j
        new = [rows[0] & equal]
        for e in range(1, limit + 1):
            new.append(rows[e] & equal | rows[e - 1] | rows[e - 1] >> 1 | new[e - 1] << 1 & full)
        if not new[limit]:
            return False
        rows = new
    return bool(rows[limit] >> (m - n + limit) & 1)


def segment_keys(line: str, limit: int = LIMIT) -> set[int]:
    """Keys of a line's segments and of the substrings that may equal another line's segment."""
    n, keys = len(line), set()
    for shorter in range(limit + 1):
        length = n - shorter
        for i in range(limit + 1):
            start, end = length * i // (limit + 1), length * (i + 1) // (limit + 1)
            seed = length * (limit + 1) + i
            # seen from the left at most i edits came before, from the right at most limit - i come after
            for shift in range(max(-i, shorter - (limit - i)), min(i, shorter + (limit - i)) + 1):
                keys.add(xxh64_intdigest(line[start + shift : end + shift].encode("utf-8", "replace"), seed))
    return keys


def keyed_lines(docs: DataFrame, min_chars: int, limit: int) -> DataFrame:
    """``id``, ``n`` characters and ``key``: a row per key of every line, a task's copies once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[int] = set()
        for batch in batches:
            ids, sizes, keys, counts = [], [], [], []
            for text in batch["text"]:
                for line in text.split("\n"):
                    if len(line) >= min_chars:
                        i = xxh64_intdigest(line.encode("utf-8", "replace"), 42)  # as Spark's xxhash64
                        if i not in done:
                            done.add(i)
                            found = segment_keys(line, limit)
                            ids.append(i)
                            sizes.append(len(line))
                            counts.append(len(found))
                            keys += found
            counts = np.array(counts, np.int64)
            for name in (ids, keys):
                name[:] = [np.array(name, np.uint64).view(np.int64)] if name else [np.empty(0, np.int64)]
            yield pd.DataFrame({"id": np.repeat(ids[0], counts), "n": np.repeat(np.array(sizes, np.int32), counts), "key": keys[0]})

    return docs.select("text").mapInPandas(run, "id long, n int, key long")


def lines_of(docs: DataFrame, min_chars: int = MIN_CHARS, exact_chars: int = MIN_CHARS) -> DataFrame:
    """Lines long enough to be compared; ``twin`` tells rows of one ``doc_id`` with other texts apart."""
    n = F.char_length("line")
    split = docs.select("doc_id", F.xxhash64("text").alias("twin"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    return split.where((n >= min_chars) | ((n >= exact_chars) & F.col("line").rlike(r"\S"))).withColumn("id", F.xxhash64("line"))


def line_texts(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id``, ``line`` and counts of character classes of the wanted lines (column ``item``), each once."""
    width = 1 << 15
    slot = F.expr(f"pmod(item, {WANTED})")
    marked = wanted.groupBy(F.floor(slot / width).cast("int").alias("part")).agg(F.expr(f"bitmap_construct_agg(pmod(pmod(item, {WANTED}), {width}))").alias("bits"))
    bits = np.zeros(WANTED // 8, dtype=np.uint8)
    for r in marked.collect():  # WANTED / width rows of 4 KB at most
        bits[r["part"] * 4096 : (r["part"] + 1) * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)[:4096]
    shared = lines.sparkSession.sparkContext.broadcast(bits)

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            s = batch["id"].to_numpy(dtype=np.int64) % WANTED
            some = batch[(shared.value[s >> 3] >> (s & 7)) & 1 == 1].drop_duplicates("id")
            chars = [np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) % CLASSES for x in some["line"]]
            if len(some):
                yield some.assign(mix=[np.bincount(c, minlength=CLASSES).astype(np.int32) for c in chars])

    some = lines.select("id", "line").mapInPandas(keep, "id long, line string, mix array<int>")
    some = some.join(wanted.select(F.col("item").alias("id")), "id", "left_semi")
    return some.groupBy("id").agg(F.first("line").alias("line"), F.first("mix").alias("mix"))


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, limit: int = LIMIT, exact_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id``, ``twin`` and the numbers of the lines that go, for documents that lose some."""
    lines = lines_of(docs, min_chars, exact_chars)
    keyed = keyed_lines(docs, min_chars, limit)
    in_key = Window.partitionBy("key")
    shared = keyed.withColumns({"lo": F.min("id").over(in_key), "hi": F.max("id").over(in_key)}).where("lo <> hi")
    postings = stage(shared.select("key", F.col("id").alias("item"), "n").distinct(), "postings")
    found = stage(line_texts(lines.where(F.char_length("line") >= min_chars), postings.select("item").distinct()), "lines")
    postings = postings.join(found.select(F.col("id").alias("item"), *[F.col("mix")[j].alias(f"c{j}") for j in range(CLASSES)]), "item")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.loc[[within(x, y, limit) for x, y in zip(batch["x"], batch["y"])], ["a", "b"]]

    def verify(pairs: DataFrame) -> DataFrame:
        a, b = found.select(F.col("id").alias("a"), F.col("line").alias("x")), found.select(F.col("id").alias("b"), F.col("line").alias("y"))
        return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInPandas(check, "a long, b long")

    def may_link(x: str, y: str) -> Column:
        """An edit changes the length by one at most, and the counts of character classes by two in all."""
        apart = lambda c: F.abs(F.col(f"{x}.{c}") - F.col(f"{y}.{c}"))
        return (apart("n") <= limit) & (sum((apart(f"c{j}") for j in range(CLASSES)), F.lit(0)) <= 2 * limit)

    labels = linked(postings, verify, may_link, ["n"])
    lines = stage(lines.select("doc_id", "twin", "at", "id"), "places")
    distinct = lines.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("times"))
    labelled = distinct.join(labels, distinct["id"] == labels["item"], "left").select("id", "doc_id", "times", F.coalesce("label", "id").alias("label"))
    groups = labelled.groupBy("label").agg(F.min("doc_id").alias("owner"), F.sum("times").alias("times"))
    several = labelled.join(groups.where("times > 1").drop("times"), "label").select("id", "label", "owner")
    by_doc = (
        lines.select("doc_id", "twin", "at", "id").join(several, "id")
        .groupBy("doc_id", "twin", "label", "owner").agg(F.collect_set("at").alias("ats"))
    )
    owned = F.col("doc_id").eqNullSafe(F.col("owner"))
    by_doc = by_doc.withColumn("ats", F.when(owned, F.array_remove("ats", F.array_min("ats"))).otherwise(F.col("ats")))
    return by_doc.where("size(ats) > 0").groupBy("doc_id", "twin").agg(F.flatten(F.collect_list("ats")).alias("drops"))


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, limit: int = LIMIT, exact_chars: int = MIN_CHARS, counts: tuple[str, str] = ("n_lines", "n_removed")
) -> DataFrame:
    """All rows and columns of ``docs`` with ``text`` as it remains and two counts added.

    ``counts`` names the columns for lines and removed lines; columns of these
    names are replaced. A missing text stays missing, an empty one empty, and
    texts that lose nothing stay as they are. Rows with one ``doc_id`` count as
    one document; missing ids come last and each such row keeps its own first
    line. An empty table gives an empty table.
    """
    plain = texts(docs)
    names = {c: fresh(docs, f"dropped_{c}") for c in ("doc_id", "twin", "drops")}
    drops = dropped_lines(plain, min_chars, limit, exact_chars).select(*[F.col(c).alias(n) for c, n in names.items()])
    owner, twin, gone = (F.col(names[c]) for c in ("doc_id", "twin", "drops"))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    joined = docs.join(drops, docs["doc_id"].cast("long").eqNullSafe(owner) & (F.xxhash64(text) == twin), "left")
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    rest = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    columns = [F.when(gone.isNull(), docs[c]).otherwise(rest).alias(c) if c == "text" else docs[c] for c in docs.columns if c not in counts]
    return joined.select(*columns, F.size(lines).alias(counts[0]), F.coalesce(F.size(gone), F.lit(0)).alias(counts[1]))


def line_digest(docs: DataFrame, exact_chars: int = MIN_CHARS) -> DataFrame:
    """Lines, removed lines and checksum of what remains per document."""
    found = dedup_lines(docs.select("doc_id", "text"), exact_chars=exact_chars)
    rest = F.coalesce("text", F.lit(""))
    return found.select("doc_id", "n_lines", F.greatest("n_removed", F.lit(0)).alias("n_removed"), F.length(rest).cast("long").alias("n_chars"), F.sha2(rest, 256).alias("text_sha256"))
