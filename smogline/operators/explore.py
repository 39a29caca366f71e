"""Exploratory aggregates: the tables behind each chart."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogline.functions.scalars import at_least_zero, bucket_colour, month_text
from smogline.operators.correlation import correlation_matrix
from smogline.schema import BUCKET, CORRELATED, DATE, INDEX, PLACE, bucket_domain, present
from smogline.session import small_table, stage


class Extent(NamedTuple):
    """Size and range of a column, missing values left out."""

    n: int
    low: float | None
    high: float | None
    deviation: float | None


def value_counts(df: DataFrame, column: str = INDEX) -> DataFrame:
    """How often each value of a column occurs, as written rows (value, n); missing ones left out.

    Extent, histogram, density and axis range all read this instead of the
    table. Equal values are merged within the map tasks, so a value that a third
    of the rows share is sent once per task.
    """
    known = df.select(F.col(column).cast("double").alias("value")).where("value is not null")
    return stage(known.groupBy("value").agg(F.count(F.lit(1)).alias("n")), "value-counts")


def extent(counts: DataFrame) -> Extent:
    """Size, range and population deviation, from value counts."""
    n, low, high, mean = counts.agg(
        F.sum("n"), F.min("value"), F.max("value"), F.sum(F.col("value") * F.col("n")) / F.sum("n")
    ).first()
    if not n:
        return Extent(0, None, None, None)
    away = F.col("value") - F.lit(mean)
    [square] = counts.agg(F.sum(away * away * F.col("n"))).first()
    return Extent(n, low, high, math.sqrt(square / n))


def mean_by(df: DataFrame, group: str, value: str, name: str = "mean_value") -> DataFrame:
    """Mean of a value per group (A3)."""
    return df.groupBy(group).agg(F.avg(value).alias(name))


def top_means(df: DataFrame, group: str = PLACE, value: str = INDEX, n: int = 15, name: str = "mean_aqi") -> DataFrame:
    """The n groups with the highest mean; equal means by name."""
    return mean_by(df, group, value, name).orderBy(F.desc_nulls_last(name), group).limit(n)


def for_display(top: DataFrame, by: str, name: str) -> DataFrame:
    """A top list from the bottom up, as a bar chart shows it (T4)."""
    return top.orderBy(F.asc_nulls_first(by), F.desc(name))


def monthly_trend(df: DataFrame, date: str = DATE, value: str = INDEX) -> DataFrame:
    """Mean per calendar month over all years, and its centred 3-month mean.

    The window has no partitions, but sees at most twelve rows.
    """
    monthly = mean_by(df.select(F.month(date).alias("Month"), value), "Month", value, "mean_aqi").where(
        F.col("Month").isNotNull()
    )
    near = Window.orderBy("Month").rowsBetween(-1, 1)
    return monthly.select(
        "Month",
        month_text(F.col("Month")).alias("label"),
        "mean_aqi",
        F.avg("mean_aqi").over(near).alias("smoothed_aqi"),
    )


def bucket_counts(df: DataFrame, bucket: str = BUCKET) -> DataFrame:
    """Rows per bucket in severity order, buckets that occur only."""
    counts = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    domain = bucket_domain(df.sparkSession).withColumnRenamed(BUCKET, bucket)
    return (
        domain.join(counts, bucket)
        .select("ord", bucket, "n", bucket_colour(F.col(bucket)).alias("colour"))
        .orderBy("ord")
    )


def histogram(df: DataFrame, column: str = INDEX, bins: int = 60, counts: DataFrame | None = None) -> DataFrame:
    """Counts in equal bins over the range, the last one closed.

    Bin edges are computed as start + k * step, and a value goes where the
    edges say, also when dividing by the width rounds the other way. A column
    with one value gets a range of one unit around it. ``counts`` are the
    column's value counts, if they are there already.
    """
    spark = df.sparkSession
    counts = value_counts(df, column) if counts is None else counts
    _, low, high, _ = extent(counts)
    if low is None:
        return small_table(spark, [], {"bin": "int", "low": "double", "high": "double", "n": "long"})
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    place = F.floor((F.col("value") - F.lit(low)) / F.lit(high - low) * F.lit(float(bins)))
    guess = F.least(place, F.lit(bins - 1)).cast("int")
    edge = F.lit(low) + F.col("guess") * F.lit(step)
    next_edge = F.lit(low) + (F.col("guess") + 1) * F.lit(step)
    settled = (
        F.when(F.col("value") < edge, F.col("guess") - 1)
        .when((F.col("value") >= next_edge) & (F.col("guess") < bins - 1), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    filled = counts.withColumn("guess", guess).select(settled.alias("bin"), "n").groupBy("bin").agg(F.sum("n").alias("n"))
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(filled, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(step)).alias("low"),
        F.when(F.col("bin") == bins - 1, F.lit(high))
        .otherwise(F.lit(low) + (F.col("bin") + 1) * F.lit(step))
        .alias("high"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def density(df: DataFrame, column: str = INDEX, points: int = 300, counts: DataFrame | None = None) -> DataFrame:
    """Gaussian kernel density on an even grid.

    Each different value, weighted by its count, spreads over the grid inside
    the task, and partial sums per grid point are all that is shuffled.
    """
    spark = df.sparkSession
    counts = value_counts(df, column) if counts is None else counts
    n, low, high, deviation = extent(counts)
    if not n:
        return small_table(spark, [], {"point": "int", "x": "double", "density": "double"})
    step = (high - low) / (points - 1)
    place = F.when(F.col("point") == points - 1, F.lit(high)).otherwise(
        F.lit(low) + F.col("point") * F.lit(step)
    )
    width = 1.06 * deviation * n ** (-0.2)
    if width == 0:
        grid = spark.range(points).select(F.col("id").cast("int").alias("point"))
        return grid.select("point", place.alias("x"), F.lit(None).cast("double").alias("density"))
    spread = counts.select("value", "n", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    z = (place - F.col("value")) / F.lit(width)
    scale = n * width * math.sqrt(2 * math.pi)
    return (
        spread.groupBy("point")
        .agg((F.sum(F.col("n") * F.exp(z * z * F.lit(-0.5))) / F.lit(scale)).alias("density"))
        .select("point", place.alias("x"), "density")
    )


def axis_range(df: DataFrame, column: str = INDEX, pad: float = 5.0, counts: DataFrame | None = None) -> DataFrame:
    """Padded range of a chart axis, not below zero."""
    value = column if counts is None else "value"
    return (df if counts is None else counts).agg(
        at_least_zero(F.min(value) - pad).alias("axis_low"),
        (F.max(value) + pad).alias("axis_high"),
    )


def explore(df: DataFrame) -> dict[str, DataFrame]:
    """All exploratory results of a cleaned table.

    The index is counted once, for histogram, density and axis range.
    """
    counts = value_counts(df)
    return {
        "histogram": histogram(df, counts=counts),
        "density": density(df, counts=counts),
        "correlation": correlation_matrix(df, present(df, CORRELATED)),
        "top_cities": top_means(df),
        "monthly_trend": monthly_trend(df),
        "bucket_counts": bucket_counts(df),
        "axis_range": axis_range(df, counts=counts),
    }


# What a row of each result is about, and what it measures.
MEASURES = {
    "histogram": (["bin"], ["low", "high", "n"]),
    "density": (["point"], ["x", "density"]),
    "correlation": (["row", "col"], ["value"]),
    "top_cities": ([PLACE], ["mean_aqi"]),
    "monthly_trend": (["Month"], ["mean_aqi", "smoothed_aqi"]),
    "bucket_counts": ([BUCKET], ["ord", "n"]),
    "axis_range": ([], ["axis_low", "axis_high"]),
}


def long_rows(bundle: dict[str, DataFrame]) -> DataFrame:
    """All exploratory results as rows (result, key, measure, value)."""
    rows = None
    for name, result in bundle.items():
        keys, measures = MEASURES[name]
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
        values = [x for m in measures for x in (F.lit(m), F.col(m).cast("double"))]
        part = result.select(
            F.lit(name).alias("result"), key.alias("key"), F.stack(F.lit(len(measures)), *values).alias("measure", "value")
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows
