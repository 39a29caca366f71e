"""Facts about a table: size, gaps, ranges, summary statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogline.operators.quantiles import summarise
from smogline.schema import DATE, PLACE
from smogline.session import small_table

QUARTILES = [0.25, 0.5, 0.75]


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, as rows (column, n_missing)."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], one.columns, "column", "n_missing")


def table_info(df: DataFrame) -> DataFrame:
    """Position, type and number of known values of each column."""
    one = df.agg(*[F.count(c).alias(c) for c in df.columns])
    kinds = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    places = F.create_map(*[F.lit(x) for i, c in enumerate(df.columns) for x in (c, i)])
    return one.unpivot([], one.columns, "column", "n_present").select(
        places[F.col("column")].alias("position"),
        "column",
        kinds[F.col("column")].alias("type"),
        "n_present",
    )


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def preview(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """First n rows in a stated order (F11); a top-n, not a full sort."""
    return df.orderBy(*(order or [PLACE, DATE])).limit(n)


def value_range(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value (A10)."""
    return df.agg(F.min(column).alias("smallest"), F.max(column).alias("largest"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column."""
    return df.select(column).distinct()


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Number of different values, missing not counted."""
    return df.agg(F.count_distinct(column).alias("n_distinct"))


def describe(df: DataFrame, columns: list[str] | None = None, digits: int | None = 2) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles.

    Two scans: the first measures all columns while it sketches them.
    """
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    parts = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    quartiles, measured = summarise(df, columns, QUARTILES, parts)
    rows = []
    for c in columns:
        m = measured[c]
        rows.append((c, m["count"], m["mean"], m["std"], m["min"], *quartiles[c], m["max"]))
    names = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    table = small_table(df.sparkSession, rows, {"column": "string", "count": "long", **dict.fromkeys(names, "double")})
    return table if digits is None else table.withColumns({n: F.round(n, digits) for n in names})


def describe_dates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The same for date columns, as moments; a date has no deviation."""
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
    days = df.select(*[F.unix_date(c).cast("double").alias(c) for c in columns])
    table = describe(days, columns, digits=None)
    # Moments without a time zone, as dates have none.
    moment = "TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, round({} * 86400D))"
    moments = ["mean", "min", "q25", "q50", "q75", "max"]
    return table.select("column", "count", *[F.expr(moment.format(m)).alias(m) for m in moments])
