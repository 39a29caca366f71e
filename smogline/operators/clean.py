"""Cleaning: drop rows without targets, fill gaps, drop copies."""

from __future__ import annotations

import logging

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogline.operators.quantiles import exact_medians
from smogline.schema import POLLUTANTS, TARGETS, present
from smogline.session import small_table

log = logging.getLogger(__name__)


def _known(df: DataFrame, target: str) -> list[Column]:
    """Conditions under which a target is known: neither NULL nor NaN."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return [F.col(target).isNotNull(), *([~F.isnan(target)] if target in floats else [])]


def drop_missing_targets(df: DataFrame, targets: list[str] = TARGETS) -> DataFrame:
    """Keep rows in which every target is known (F1).

    Written as predicates, not as ``dropna``, so that they reach the scan.
    """
    for target in targets:
        for condition in _known(df, target):
            df = df.where(condition)
    return df


def fill_medians(
    df: DataFrame,
    columns: list[str] = POLLUTANTS,
    medians: dict[str, float | None] | None = None,
) -> DataFrame:
    """Fill the gaps of each column with its median.

    Columns the table lacks are passed over; a column without any value stays
    empty. The medians come as literals, so filling is a plain projection.
    """
    columns = present(df, columns)
    if not columns:
        log.warning("none of the measured columns is present; nothing filled")
        return df
    if medians is None:
        medians = exact_medians(df, columns)
    known = {c: medians[c] for c in columns if medians.get(c) is not None}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in known.items()})


def drop_copies(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows; missing equals missing (A2).

    Copies meet in the map-side aggregation first, so that even a row that
    makes up a third of the table reaches its reducer once per map task.
    """
    return df.dropDuplicates()


def clean(df: DataFrame, columns: list[str] = POLLUTANTS, targets: list[str] = TARGETS) -> DataFrame:
    """Targets, then medians over what is left, then copies.

    Copies go last: rows that filling makes equal fall together. The medians
    scan the table several times, so stage raw text first.
    """
    return drop_copies(fill_medians(drop_missing_targets(df, targets), columns))


def cleaning_audit(
    raw: DataFrame,
    cleaned: DataFrame,
    columns: list[str] = POLLUTANTS,
    targets: list[str] = TARGETS,
) -> DataFrame:
    """What each cleaning step did, as rows (step, n).

    One pass over each table. A gap in a kept row was filled unless its column
    has no value at all among the kept rows.
    """
    columns = present(raw, columns)
    known = F.lit(True)
    for target in targets:
        for condition in _known(raw, target):
            known = known & condition
    gaps = {c: F.count_if(known & F.col(c).isNull()) for c in columns}
    before = raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(known).alias("kept"),
        *[n.alias(f"gap_{c}") for c, n in gaps.items()],
    )
    empty = [F.when(F.col(f"gap_{c}") == F.col("kept"), F.col("kept")).otherwise(0) for c in columns]
    gap_total = sum((F.col(f"gap_{c}") for c in columns), F.lit(0))
    left_total = sum(empty, F.lit(0))
    steps = before.select(
        F.col("rows").alias("raw_rows"),
        (F.col("rows") - F.col("kept")).alias("dropped_without_target"),
        F.col("kept").alias("rows_with_targets"),
        (gap_total - left_total).alias("values_filled"),
        left_total.alias("values_still_missing"),
    )
    after = cleaned.agg(F.count(F.lit(1)).alias("clean_rows"))
    both = steps.unpivot([], steps.columns, "step", "n").unionByName(
        after.unpivot([], after.columns, "step", "n")
    )
    names = [*steps.columns, *after.columns]
    wide = both.agg(*[F.sum(F.when(F.col("step") == s, F.col("n"))).alias(s) for s in names])
    copies = F.col("rows_with_targets") - F.col("clean_rows")
    return wide.withColumn("copies_removed", copies).unpivot([], [*names, "copies_removed"], "step", "n")


def audited_clean(
    df: DataFrame, columns: list[str] = POLLUTANTS, targets: list[str] = TARGETS
) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The cleaned table, and the audit of its cleaning to be read after it was written once.

    Each step counts the rows that pass it while they pass, so neither table is
    scanned for the audit. Rows and steps are those of ``cleaning_audit``.
    """
    columns = present(df, columns)
    seen = {step: Observation(f"{step}-{id(df)}") for step in ("raw", "kept", "filled", "clean")}
    rows = F.count(F.lit(1)).alias("rows")

    def gaps() -> Column:
        return sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0)).cast("long").alias("gaps")

    medians = exact_medians(drop_missing_targets(df, targets), columns)
    kept = drop_missing_targets(df.observe(seen["raw"], rows), targets).observe(seen["kept"], rows, gaps())
    filled = fill_medians(kept, columns, medians).observe(seen["filled"], gaps())
    cleaned = drop_copies(filled).observe(seen["clean"], rows)

    def audit() -> DataFrame:
        raw, passed = seen["raw"].get["rows"], seen["kept"].get["rows"]
        before, after, left = seen["kept"].get["gaps"], seen["filled"].get["gaps"], seen["clean"].get["rows"]
        steps = {
            "raw_rows": raw, "dropped_without_target": raw - passed, "rows_with_targets": passed,
            "values_filled": before - after, "values_still_missing": after, "clean_rows": left, "copies_removed": passed - left,
        }
        return small_table(df.sparkSession, list(steps.items()), {"step": "string", "n": "long"})

    return cleaned, audit
