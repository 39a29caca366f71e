"""Reproducible train/test split of exact size, without sorting the table.

Each row gets a pseudo-random key that depends on its content only. The test
rows are those with the smallest keys, up to a threshold found by exact rank
selection. So the split is a filter: no shuffle of rows, the same result for
any partitioning, and again after a lost executor. Copies of a row share their
key; where the threshold falls on them, they are divided by their number.

A stratified split has a threshold per class. Counts, test sizes and thresholds
are tables with a row per class, joined to the rows by class, so any number of
classes will do, and the driver sees none of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.operators.quantiles import RANKED_ROWS, Hit, select_ranks
from smogline.operators.rank import with_place
from smogline.session import stage

SEED = 42
TEST_SHARE = 0.2


# Keys are even over this many values.
KEYS = 1 << 52
# Copies written out by one task at a time.
CHUNK = 1_000_000
# Name of the only class of an unstratified split.
ALL = "all"


def row_key(columns: list[str], seed: int = SEED) -> Column:
    """52-bit key from the content of the columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12)


def text_key(text: Column, seed: int = SEED) -> Column:
    """52-bit key from a text that identifies the row, the same in other engines."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), text))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def test_size(rows: int, share: float = TEST_SHARE) -> int:
    return math.ceil(share * rows)


def _expected(rank: int, rows: int) -> list[int]:
    """Where the key of a rank should lie, as keys are even: the place and a margin."""
    place = (rank + 0.5) / rows
    margin = 6.0 * math.sqrt(place * (1 - place) / rows)
    return [int(KEYS * min(1.0, max(0.0, place + m))) for m in (-margin, margin)]


def _near(keyed: DataFrame, label: list[str]) -> DataFrame:
    """The row with ``n_test`` of each class among its keys from ``low`` to ``high``, in one scan; none where it lies elsewhere.

    Keys within are counted one by one, all below them together, those above
    not at all. Keys are even, so few lie within.
    """
    single = F.when(F.col("_key") >= F.col("low"), F.col("_key"))
    counted = keyed.where("_key <= high").groupBy(*label, "n_test", single.alias("_last")).agg(F.count(F.lit(1)).alias("n"))
    ascending = Window.partitionBy(*label, "n_test").orderBy(F.asc_nulls_first("_last")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_upto", F.sum("n").over(ascending)).withColumn("_below", F.col("_upto") - F.col("n"))
    found = ranked.where("_last is not null and n_test <= _upto and n_test > _below")
    return found.select(*label, "n_test", "_last", "_below", "_upto")


def _divide(marked: DataFrame, columns: list[str], label: list[str], name: str) -> DataFrame:
    """Where the last key of a class belongs to more rows than are wanted, mark only part of them.

    marked: rows with ``name``, and ``_left``: NULL, or for rows with that key
    how many of them go to the test side. They are copies of each other: the
    copies are counted, the counts divided, and the copies written out again in
    chunks, so that no task holds them all.
    """
    earlier = Window.partitionBy(*label).orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    counted = marked.where("_left is not null").groupBy(*columns, "_left").agg(F.count(F.lit(1)).alias("_n"))
    divided = counted.withColumn(
        "_test",
        F.greatest(F.lit(0), F.least("_n", F.col("_left") - F.coalesce(F.sum("_n").over(earlier), F.lit(0)))),
    )
    sides = divided.select(
        *columns, F.expr("stack(2, true, _test, false, _n - _test)").alias(name, "_copies")
    ).where("_copies > 0")
    chunks = sides.withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {CHUNK}L)")))
    size = F.least(F.lit(CHUNK), F.col("_copies") - F.col("_chunk") * CHUNK)
    shared = chunks.repartition("_chunk").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size)))
    return marked.where("_left is null").select(*columns, name).unionByName(shared.select(*columns, name))


def random_split(
    df: DataFrame,
    key: Column | None = None,
    share: float = TEST_SHARE,
    name: str = "is_test",
    ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """Mark ceil(share * rows) rows as test rows (M3).

    ``key`` is a whole number below KEYS, even over that range.
    """
    key = row_key(df.columns) if key is None else key
    rows = df.count()
    wanted = test_size(rows, share)
    if not wanted:
        return df.withColumn(name, F.lit(False))
    low, high = _expected(wanted - 1, rows)
    keyed = df.select(key.alias("_key"), F.lit(wanted).alias("n_test"), F.lit(low).alias("low"), F.lit(high).alias("high"))
    near = _near(keyed, []).first() if (high - low) / KEYS * rows <= ranked_rows else None
    if near:
        hit = Hit(near["_last"], near["_below"], near["_upto"])
    else:
        [hit] = select_ranks(
            df.select(key.alias("key")),
            {ALL: F.col("key")},
            {ALL: [wanted - 1]},
            {ALL: rows},
            ranked_rows,
            {ALL: [low, high]},
        )[ALL].values()
    marked = df.withColumn(name, F.coalesce(key <= hit.value, F.lit(False)))
    if hit.upto == wanted:
        return marked
    return _divide(marked.withColumn("_left", F.when(key == hit.value, wanted - hit.below)), df.columns, [], name)


def class_test_sizes(counts: dict[str, int], share: float = TEST_SHARE) -> dict[str, int]:
    """Test rows per class, by largest remainder of the train shares.

    Equal remainders go by class name.
    """
    rows = sum(counts.values())
    train = rows - test_size(rows, share)
    whole = {c: n * train // rows for c, n in counts.items()}
    by_rest = sorted(counts, key=lambda c: (-(counts[c] * train % rows), c))
    extra = set(by_rest[: train - sum(whole.values())])
    return {c: n - whole[c] - (c in extra) for c, n in counts.items()}


def class_sizes(counts: DataFrame, label: str, rows: int, share: float = TEST_SHARE) -> DataFrame:
    """The same for a table of classes with their rows ``n``: adds ``n_test``. ``rows`` is the sum of all ``n``."""
    train = rows - test_size(rows, share)
    product = f"CAST(n AS DECIMAL(19, 0)) * CAST({train} AS DECIMAL(19, 0))"
    shares = counts.select(
        label, "n", F.expr(f"{product} div {rows}").cast("long").alias("whole"), F.expr(f"{product} % {rows}").cast("long").alias("rest")
    )
    spare = train - (shares.agg(F.sum("whole")).first()[0] or 0)
    placed = with_place(shares, [F.desc("rest"), F.asc(label)], "place")
    return placed.select(label, "n", (F.col("n") - F.col("whole") - (F.col("place") < spare).cast("long")).alias("n_test"))


def _class_thresholds(keyed: DataFrame, label: str, sizes: DataFrame, ranked_rows: int) -> DataFrame:
    """Per class the last test key ``last``, and how many rows lie ``below`` and ``upto`` it.

    One scan finds those that lie where they should by their rank, as in a
    random split; the others are searched by two levels.
    """
    sizes = sizes.where("n_test > 0")
    place = F.expr("(n_test - 0.5D) / n")
    margin = F.lit(6.0) * F.sqrt(place * (1 - place) / F.col("n"))
    low, high = (F.least(F.lit(1.0), F.greatest(F.lit(0.0), end)) for end in (place - margin, place + margin))
    wanted = sizes.select(label, "n_test", (low * KEYS).cast("long").alias("low"), (high * KEYS).cast("long").alias("high"), ((high - low) * F.col("n")).alias("within"))
    near = stage(_near(keyed.join(wanted.where(F.col("within") <= ranked_rows).drop("within"), label), [label]), "class-near")
    others = sizes.join(near.select(label), label, "left_anti")
    return near if others.isEmpty() else near.unionByName(_searched_thresholds(keyed, label, others, ranked_rows))


def _searched_thresholds(keyed: DataFrame, label: str, sizes: DataFrame, ranked_rows: int) -> DataFrame:
    """The same for classes whose keys may lie anywhere.

    First level: keys are even, so a class is counted in equal ranges of keys,
    about ``ranked_rows`` rows each. Second level: the range in which the wanted
    row lies is ranked.
    """
    width = F.ceil(F.lit(float(KEYS)) / F.ceil(F.col("n") / ranked_rows))
    wanted = sizes.select(label, "n_test", width.cast("long").alias("width"))
    ranges = keyed.join(wanted, label).groupBy(label, "n_test", "width", F.expr("_key div width").alias("range")).agg(F.count(F.lit(1)).alias("n"))
    ascending = Window.partitionBy(label).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ranges.withColumn("upto", F.sum("n").over(ascending))
    ranges = ends.where("n_test <= upto and n_test > upto - n").select(label, "n_test", "width", "range", (F.col("upto") - F.col("n")).alias("before"))
    ranges = stage(ranges, "class-ranges")
    near = keyed.join(ranges, label).where("_key div width = range")
    keys = near.groupBy(label, "n_test", "before", "_key").agg(F.count(F.lit(1)).alias("n"))
    ascending = Window.partitionBy(label).orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = keys.withColumn("_upto", F.col("before") + F.sum("n").over(ascending)).withColumn("_below", F.col("_upto") - F.col("n"))
    return ranked.where("n_test <= _upto and n_test > _below").select(label, "n_test", F.col("_key").alias("_last"), "_below", "_upto")


def stratified_split(
    df: DataFrame,
    label: str,
    key: Column | None = None,
    share: float = TEST_SHARE,
    name: str = "is_test",
    ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """Mark test rows so that every class keeps its share (M4). The label is required."""
    key = row_key(df.columns) if key is None else key
    counts = stage(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")), "class-counts")
    rows, unknown = counts.agg(F.sum("n"), F.count_if(F.col(label).isNull())).first()
    if unknown:
        raise ValueError(f"rows without {label}; drop them before a stratified split")
    if not rows:
        return df.withColumn(name, F.lit(False))
    sizes = stage(class_sizes(counts, label, rows, share), "class-sizes")
    keyed = df.select(label, key.alias("_key"))
    last = _class_thresholds(keyed, label, sizes, ranked_rows)
    last = stage(last.select(label, "_last", F.when(F.col("_upto") != F.col("n_test"), F.col("n_test") - F.col("_below")).alias("_tied")), "class-thresholds")
    marked = df.withColumn("_key", key).join(last, label, "left").withColumn(name, F.coalesce(F.col("_key") <= F.col("_last"), F.lit(False)))
    if last.where("_tied is not null").isEmpty():
        return marked.select(*df.columns, name)
    left = F.when(F.col("_key") == F.col("_last"), F.col("_tied"))
    return _divide(marked.withColumn("_left", left), df.columns, [label], name)
