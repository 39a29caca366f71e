"""Dictionary codes: sorted distinct texts, counted from zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.functions.calendar import with_calendar
from smogline.schema import BUCKET, DATE, INDEX, PLACE, PLACE_CODE, POLLUTANTS, CALENDAR, present
from smogline.session import stage

# Distinct texts that a single task may sort.
SORTED_ROWS = 1_000_000


def as_text(column: Column) -> Column:
    """The value as text; a missing one is the text nan (F8)."""
    return F.coalesce(column.cast("string"), F.lit("nan"))


def dictionary(df: DataFrame, column: str, sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """Distinct texts of a column with their codes, as (value, code).

    The distinct texts are staged, so the table is scanned once and a join with
    the dictionary is planned from its real size: broadcast when small, else a
    shuffle that AQE splits where a text is frequent.
    """
    values = stage(df.select(as_text(F.col(column)).alias("value")).distinct(), "dictionary")
    if values.count() <= sorted_rows:
        code = F.row_number().over(Window.orderBy("value")) - 1
        return values.select("value", code.cast("int").alias("code"))
    return _codes_by_range(values)


def _codes_by_range(values: DataFrame) -> DataFrame:
    """Codes for a dictionary too long for one task: sort ranges, then offset them."""
    ranges = stage(
        values.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "ranges"
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy("value")) - 1
    return (
        ranges.withColumn("inside", inside)
        .join(offsets, "part")
        .select("value", (F.col("offset") + F.col("inside")).cast("int").alias("code"))
    )


def encode(df: DataFrame, column: str, codes: DataFrame, name: str) -> DataFrame:
    """Add the code of each row's text (J3); NULL for a text not in the dictionary."""
    lookup = codes.select(F.col("value").alias("_value"), F.col("code").alias(name))
    return df.join(lookup, as_text(F.col(column)) == F.col("_value"), "left").drop("_value")


def decode(df: DataFrame, code: str, codes: DataFrame, name: str) -> DataFrame:
    """Add the text of each row's code."""
    lookup = codes.select(F.col("code").alias("_code"), F.col("value").alias(name))
    return df.join(lookup, F.col(code).cast("int") == F.col("_code"), "left").drop("_code")


def feature_matrix(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Measured columns, calendar parts, place code and both targets.

    Features and targets stay in one table. ``keep`` names further columns.
    """
    columns = [*present(df, POLLUTANTS), *CALENDAR, PLACE_CODE, INDEX, BUCKET]
    coded = encode(with_calendar(df, DATE), PLACE, dictionary(df, PLACE), PLACE_CODE)
    return coded.select(*(keep or []), *columns)
