"""Exact order statistics without holding a column in one task.

``percentile`` and ``median`` keep a value-to-count map per column on a single
reducer. Here a column is narrowed instead: mergeable sketches suggest pivot
values, counts tell on which side of each pivot the wanted ranks lie, and only
the open interval around them stays. When few enough rows are left they are
ranked exactly. The sketches steer the search; the counts decide, so the answer
does not depend on how good a sketch is.

Quantiles take two scans at any size. The first makes the sketches, along with
other measures of the columns. The second gives every value the number of its
bucket between the pivots and counts it; values next to the wanted ranks (a few
in ten thousand, by the bound of the sketch) keep themselves as well. These
counts are written, and all further narrowing reads them instead of the table.
``select_ranks`` narrows by scans of the table; it serves keys whose
distribution is known, so that its first pivots are near.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.session import small_table, stage

# Rows of one interval that a single task may rank.
RANKED_ROWS = 1 << 18
SKETCH_ACCURACY = 10_000
# Columns of so many values keep all of them; with more, the error of a sketch
# is at least some ranks, and twice the error covers rounding too.
KEPT_WHOLE = 1 << 18
# Counters per pass.
COUNTERS = 60


class Hit(NamedTuple):
    """A value at a wanted rank, and how many values lie below and up to it."""

    value: float
    below: int
    upto: int


@dataclass(frozen=True)
class Interval:
    """Open interval of one series that holds the wanted ranks."""

    series: str
    ranks: tuple[int, ...]
    below: int
    inside: int
    low: float | None = None
    high: float | None = None

    def kept(self, value: Column) -> Column:
        """The value where it lies inside, else NULL."""
        inside = value.isNotNull()
        if self.low is not None:
            inside = inside & (value > F.lit(self.low))
        if self.high is not None:
            inside = inside & (value < F.lit(self.high))
        return F.when(inside, value)


def select_ranks(
    df: DataFrame,
    series: dict[str, Column],
    ranks: dict[str, list[int]],
    counts: dict[str, int],
    ranked_rows: int = RANKED_ROWS,
    guesses: dict[str, list[float]] | None = None,
) -> dict[str, dict[int, Hit]]:
    """Values at zero-based ranks of each series, NULLs left out.

    ``counts`` has the number of non-NULL values per series. All series share
    one numeric type; integers must fit a double exactly. ``guesses`` gives
    the first pivots where the distribution is known; a bad guess costs a
    pass, not the result.
    """
    found: dict[str, dict[int, Hit]] = {name: {} for name in ranks}
    todo = [
        Interval(name, tuple(sorted(set(wanted))), 0, counts[name])
        for name, wanted in ranks.items()
        if wanted
    ]
    while wide := [i for i in todo if i.inside > ranked_rows]:
        todo = [i for i in todo if i.inside <= ranked_rows]
        if guesses is None:
            pivots = _suggest_pivots(df, series, wide)
        else:
            pivots, guesses = [sorted(set(guesses[i.series])) for i in wide], None
        sizes = _count_around(df, series, wide, pivots)
        for interval, values, around in zip(wide, pivots, sizes):
            hits, narrower = _narrow(interval, values, around)
            found[interval.series].update(hits)
            todo.extend(narrower)
    for name, rank, hit in _rank_inside(df, series, todo):
        found[name][rank] = hit
    return found


def _suggest_pivots(df, series, intervals) -> list[list[float]]:
    margin = 2.0 / SKETCH_ACCURACY
    sketches = []
    for number, interval in enumerate(intervals):
        places = [(r - interval.below) / max(interval.inside - 1, 1) for r in interval.ranks]
        around = set()
        for k, place in enumerate(places):
            # Neighbouring ranks share a pair of pivots.
            if k == 0 or place - places[k - 1] > margin:
                around.add(max(0.0, place - margin))
            if k + 1 == len(places) or places[k + 1] - place > margin:
                around.add(min(1.0, place + margin))
        sketches.append(
            F.percentile_approx(
                interval.kept(series[interval.series]), sorted(around), SKETCH_ACCURACY
            ).alias(f"s{number}")
        )
    return [sorted(set(values)) for values in df.agg(*sketches).first()]


def _count_around(df, series, intervals, pivots) -> list[list[tuple[int, int]]]:
    """For each pivot, how many values lie below it and up to it.

    Counters go in batches small enough for compiled code. A batch holds whole
    series, so the batches together read each column once.
    """
    around: list[list[tuple[int, int]]] = []
    batch: list[tuple[Column, list[float]]] = []

    def count() -> None:
        counters = [
            F.count_if(c)
            for value, values in batch
            for v in values
            for c in (value < F.lit(v), value <= F.lit(v))
        ]
        flat = iter(df.agg(*[c.alias(f"n{k}") for k, c in enumerate(counters)]).first())
        around.extend([(next(flat), next(flat)) for _ in values] for _, values in batch)
        batch.clear()

    for interval, values in zip(intervals, pivots):
        if batch and 2 * sum(len(vs) for _, vs in batch) + 2 * len(values) > COUNTERS:
            count()
        batch.append((series[interval.series], values))
    count()
    return around


def _narrow(interval, pivots, around) -> tuple[dict[int, Hit], list[Interval]]:
    hits: dict[int, Hit] = {}
    gaps: dict[int, list[int]] = {}
    for rank in interval.ranks:
        position = sum(upto <= rank for _, upto in around)
        if position < len(pivots) and around[position][0] <= rank:
            hits[rank] = Hit(pivots[position], *around[position])
        else:
            gaps.setdefault(position, []).append(rank)
    end = interval.below + interval.inside
    narrower = []
    for position, ranks in gaps.items():
        below = around[position - 1][1] if position else interval.below
        upto = around[position][0] if position < len(pivots) else end
        narrower.append(
            Interval(
                interval.series,
                tuple(ranks),
                below,
                upto - below,
                pivots[position - 1] if position else interval.low,
                pivots[position] if position < len(pivots) else interval.high,
            )
        )
    return hits, narrower


def _rank_inside(df, series, intervals) -> list[tuple[str, int, Hit]]:
    if not intervals:
        return []
    names = [f"i{k}" for k in range(len(intervals))]
    kept = [i.kept(series[i.series]).alias(n) for n, i in zip(names, intervals)]
    upto = Window.partitionBy("interval").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    wanted = F.create_map(
        *[
            part
            for n, i in zip(names, intervals)
            for part in (F.lit(n), F.array(*[F.lit(r - i.below) for r in i.ranks]))
        ]
    )
    running = (
        df.select(*kept)
        .unpivot([], names, "interval", "value")
        .where(F.col("value").isNotNull())
        .groupBy("interval", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(upto))
    )
    hits = running.withColumn("rank", F.explode(wanted[F.col("interval")])).where(
        (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    )
    by_name = dict(zip(names, intervals))
    found = []
    for r in hits.select("interval", "rank", "value", "n", "upto").collect():
        interval = by_name[r["interval"]]
        upto = interval.below + r["upto"]
        hit = Hit(r["value"], upto - r["n"], upto)
        found.append((interval.series, interval.below + r["rank"], hit))
    return found


@dataclass(frozen=True)
class Gap:
    """Open interval of one column's written counts that holds wanted ranks; ``values`` different ones lie inside."""

    column: int
    bucket: int
    below: int
    values: int
    ranks: tuple[int, ...]
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        inside = (F.col("column") == self.column) & (F.col("bucket") == self.bucket)
        if self.low is not None:
            inside = inside & (F.col("value") > F.lit(self.low))
        if self.high is not None:
            inside = inside & (F.col("value") < F.lit(self.high))
        return inside


def _bucket(value: Column, pivots: list[float]) -> Column:
    """2 k for values between pivots k - 1 and k, 2 k + 1 for pivot k itself."""
    number = F.lit(2 * len(pivots))
    for k in reversed(range(len(pivots))):
        number = F.when(value < F.lit(pivots[k]), 2 * k).when(value == F.lit(pivots[k]), 2 * k + 1).otherwise(number)
    return F.when(value.isNotNull(), number)


def summarise(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    measures: dict[str, Callable[[Column], Column]] | None = None,
    ranked_rows: int = RANKED_ROWS,
) -> tuple[dict[str, list[float | None]], dict[str, dict[str, float]]]:
    """Exact quantiles and other measures of each column, in two scans of the table.

    Quantiles interpolate linearly between neighbours; a column without values
    gives None. The result is a few numbers per column.
    """
    if not columns:
        return {}, {}
    measures = measures or {}
    margin = 2.0 / SKETCH_ACCURACY
    places = sorted({min(1.0, max(0.0, p + d)) for p in probabilities for d in (-margin, margin)})
    series = {c: F.col(c).cast("double") for c in columns}
    first = df.agg(
        *[
            F.struct(
                F.count(v).alias("_count"),
                F.percentile_approx(v, places, SKETCH_ACCURACY).alias("_sketch"),
                *[f(v).alias(name) for name, f in measures.items()],
            ).alias(f"c{k}")
            for k, v in enumerate(series.values())
        ]
    ).first()
    seen = [first[f"c{k}"] for k in range(len(columns))]
    counts = {c: s["_count"] for c, s in zip(columns, seen)}
    measured = {c: {name: s[name] for name in measures} for c, s in zip(columns, seen)}

    pivots, kept = [], []
    for c, s in zip(columns, seen):
        at_place = dict(zip(places, s["_sketch"] or []))
        pivots.append(sorted(set(at_place.values())))
        near = set()
        for p in probabilities if at_place else []:
            low, high = (pivots[-1].index(at_place[min(1.0, max(0.0, p + d))]) for d in (-margin, margin))
            near |= {2 * k for k in range(low + 1, high + 1)}
        kept.append(set(range(0, 2 * len(pivots[-1]) + 1, 2)) if counts[c] <= KEPT_WHOLE else near)
    numbered = df.select(
        *[v.alias(f"v{k}") for k, v in enumerate(series.values())],
        *[_bucket(v, pivots[k]).alias(f"b{k}") for k, v in enumerate(series.values())],
    )
    parts = []
    for k in range(len(columns)):
        stays = F.when(F.col(f"b{k}").isin(kept[k]), F.col(f"v{k}")) if kept[k] else F.lit(None).cast("double")
        parts += [F.lit(k), F.col(f"b{k}"), stays]
    counted = (
        numbered.select(F.stack(F.lit(len(columns)), *parts).alias("column", "bucket", "value"))
        .where("bucket is not null")
        .groupBy("column", "bucket", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = stage(counted, "value-counts")

    steps = {c: [(counts[c] - 1) * p for p in probabilities] for c in columns if counts[c]}
    ranks = {c: sorted({f(x) for x in xs for f in (math.floor, math.ceil)}) for c, xs in steps.items()}
    sizes: dict[int, list[tuple[int, int, int]]] = {}
    for r in counted.groupBy("column", "bucket").agg(F.sum("n").alias("n"), F.count("value").alias("values")).collect():
        sizes.setdefault(r["column"], []).append((r["bucket"], r["n"], r["values"]))
    found: dict[str, dict[int, float]] = {c: {} for c in columns}
    gaps, unkept = [], {}
    for k, c in enumerate(columns):
        below = 0
        for bucket, n, values in sorted(sizes.get(k, [])):
            inside = tuple(r for r in ranks[c] if below <= r < below + n)
            if inside and bucket % 2:
                found[c].update(dict.fromkeys(inside, pivots[k][bucket // 2]))
            elif inside and bucket in kept[k]:
                gaps.append(Gap(k, bucket, below, values, inside))
            elif inside:  # a sketch beyond its bound
                unkept.setdefault(c, []).extend(inside)
            below += n
    for k, rank, value in _rank_counted(counted, gaps, ranked_rows):
        found[columns[k]][rank] = value
    if unkept:
        late = select_ranks(df, {c: series[c] for c in unkept}, unkept, counts, ranked_rows)
        for c, hits in late.items():
            found[c].update({rank: hit.value for rank, hit in hits.items()})
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    for c, xs in steps.items():
        result[c] = [_between(found[c][math.floor(x)], found[c][math.ceil(x)], x - math.floor(x)) for x in xs]
    return result, measured


def _rank_counted(counted: DataFrame, gaps: list[Gap], ranked_rows: int) -> list[tuple[int, int, float]]:
    """(column, rank, value) of all ranks in the gaps, from the written counts alone."""
    while wide := [g for g in gaps if g.values > ranked_rows]:
        gaps = [g for g in gaps if g.values <= ranked_rows] + _narrower(counted, wide)
    if not gaps:
        return []
    inside = _labelled(counted, gaps)
    upto = Window.partitionBy("gap").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = inside.withColumn("upto", F.sum("n").over(upto))
    wanted = F.array(*[F.array(*[F.lit(r - g.below).cast("long") for r in g.ranks]) for g in gaps])
    hits = running.withColumn("rank", F.explode(wanted[F.col("gap")])).where("rank < upto and rank >= upto - n")
    return [(gaps[r["gap"]].column, gaps[r["gap"]].below + r["rank"], r["value"]) for r in hits.select("gap", "rank", "value").collect()]


def _labelled(counted: DataFrame, gaps: list[Gap]) -> DataFrame:
    number = F.lit(None).cast("int")
    for k, gap in enumerate(gaps):
        number = F.when(gap.holds(), k).otherwise(number)
    return counted.withColumn("gap", number).where("gap is not null")


def _narrower(counted: DataFrame, gaps: list[Gap]) -> list[Gap]:
    """Each gap cut at pivots between its values; the parts that hold its ranks."""
    places = [k / 32 for k in range(33)]
    inside = _labelled(counted, gaps)
    sketches = inside.groupBy("gap").agg(F.percentile_approx("value", places, 1000).alias("pivots"))
    pivots = {r["gap"]: sorted(set(r["pivots"])) for r in sketches.collect()}
    number = F.lit(None).cast("int")
    for k, own in pivots.items():
        number = F.when(F.col("gap") == k, _bucket(F.col("value"), own)).otherwise(number)
    totals = inside.withColumn("part", number).groupBy("gap", "part").agg(F.sum("n").alias("n"), F.count("value").alias("values"))
    sizes: dict[int, list[tuple[int, int, int]]] = {}
    for r in totals.collect():
        sizes.setdefault(r["gap"], []).append((r["part"], r["n"], r["values"]))
    parts = []
    for k, gap in enumerate(gaps):
        below = gap.below
        for part, n, values in sorted(sizes[k]):
            ranks = tuple(r for r in gap.ranks if below <= r < below + n)
            own = pivots[k]
            if ranks and part % 2:  # a pivot itself: an interval with one value
                low, high = (math.nextafter(own[part // 2], end) for end in (-math.inf, math.inf))
                parts.append(replace(gap, ranks=ranks, below=below, values=1, low=low, high=high))
            elif ranks:
                low = own[part // 2 - 1] if part else gap.low
                high = own[part // 2] if part // 2 < len(own) else gap.high
                parts.append(replace(gap, ranks=ranks, below=below, values=values, low=low, high=high))
            below += n
    return parts


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    ranked_rows: int = RANKED_ROWS,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between neighbours, in two scans.

    A column without values gives None. The result is a few numbers per column.
    """
    return summarise(df, columns, probabilities, ranked_rows=ranked_rows)[0]


def _between(low: float, high: float, share: float) -> float:
    # Halves are averaged, so that a median is the mean of the middle two;
    # otherwise the step starts from the nearer neighbour.
    if share == 0.5:
        return (low + high) / 2
    if share < 0.5:
        return low + (high - low) * share
    return high - (high - low) * (1 - share)


def exact_medians(
    df: DataFrame, columns: list[str], ranked_rows: int = RANKED_ROWS
) -> dict[str, float | None]:
    """Median of each column, NULLs left out (A1)."""
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5], ranked_rows).items()}


def median_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """The medians as rows (column, median)."""
    rows = list(exact_medians(df, columns).items())
    return small_table(df.sparkSession, rows, {"column": "string", "median": "double"})
