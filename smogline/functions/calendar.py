"""Calendar parts of a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.schema import DATE


def calendar_parts(day: Column) -> dict[str, Column]:
    """Seven features; day of week counts from Monday = 0."""
    return {
        "Year": F.year(day),
        "Month": F.month(day),
        "Day": F.dayofmonth(day),
        "DayOfWeek": F.weekday(day),
        "Quarter": F.quarter(day),
        "DayOfYear": F.dayofyear(day),
        "IsWeekend": F.weekday(day) >= 5,
    }


def to_day(column: Column) -> Column:
    """Text or timestamp as a date, NULL where it does not parse."""
    return column.try_cast("date")


def with_calendar(df: DataFrame, date: str = DATE) -> DataFrame:
    """Add the seven calendar features (M1)."""
    return df.withColumns(calendar_parts(F.col(date)))
