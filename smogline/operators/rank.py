"""Places in a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.session import stage


def with_place(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """Add the place of each row from 0, in two levels: sorted ranges, then offsets of the ranges.

    The ranges are written, so that both levels see the same ones. Rows that the
    order does not tell apart get their places by chance.
    """
    part, inside = f"{name}_part", f"{name}_inside"
    ranges = stage(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = ranges.groupBy(part).agg(F.count(F.lit(1)).alias(name)).select(part, F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name))
    numbered = ranges.withColumn(inside, F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1)
    return numbered.join(offsets, part).select(*df.columns, (F.col(name) + F.col(inside)).alias(name))
