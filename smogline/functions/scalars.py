"""Column functions for safe arithmetic and display text."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogline.schema import BUCKETS, OTHER_COLOUR


def safe_divide(a: Column, b: Column, default: Column | None = None) -> Column:
    """a / b, or the default where that is undefined or either is no number."""
    quotient = F.try_divide(a.try_cast("double"), b.try_cast("double"))
    return quotient if default is None else F.coalesce(quotient, default)


def exact_rounded(value: Column, digits: int) -> Column:
    """A double rounded by its binary value, halves to even, as a decimal.

    Rounding the shortest decimal text of a double instead goes wrong where that
    text ends in a 5 that the binary value does not quite reach. The double is
    taken apart into a whole number and a power of two, and both are compared
    as decimals. From 2^40 on, and beyond 6 digits, the decimal text is rounded.
    """
    size = F.abs(value)
    power = (53 - F.floor(F.log2(size))).cast("int")
    whole = (size * F.pow(F.lit(2.0), power)).cast("long").cast("decimal(19,0)")
    one = F.lit(1).cast("long")
    below = F.shiftleft(one, 55).cast("decimal(19,0)") * F.call_function("shiftleft", one, power - 55).cast("decimal(18,0)")
    step = F.when(power < 56, F.call_function("shiftleft", one, power).cast("decimal(19,0)").cast("decimal(38,0)")).otherwise(below)
    scaled = whole * F.lit(Decimal(10**digits)).cast("decimal(18,0)")
    rest = scaled % step
    units = ((scaled - rest) / step).cast("long")
    up = (rest * 2 > step) | ((rest * 2 == step) & (units % 2 == 1))
    units = F.when(power > 110, 0).otherwise(units + up.cast("long"))
    exact = F.signum(value).cast("long") * units
    shown = (exact.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(38,{digits})")
    plain = F.bround(value, digits).cast(f"decimal(38,{digits})")
    return F.when(size == 0, F.lit(Decimal(0))).when((size < 2.0**40) & F.lit(digits <= 6), shown).otherwise(plain).cast(f"decimal(38,{digits})")


def percent_text(ratio: Column, digits: int = 1) -> Column:
    """A ratio as percent text, N/A where it is no number (X11)."""
    value = ratio.try_cast("double")
    number = exact_rounded(F.abs(F.when(F.abs(value) < float("inf"), value * 100.0)), digits)
    shown = F.concat(F.when(value < 0, "-").otherwise(""), number.cast("string"), F.lit("%"))
    return (
        F.when(value.isNull(), "N/A")
        .when(F.isnan(value), "nan%")
        .when(value == float("inf"), "inf%")
        .when(value == float("-inf"), "-inf%")
        .otherwise(shown)
    )


def grouped_text(value: Column, digits: int = 1) -> Column:
    """A number with thousands separators."""
    return F.format_number(value, digits)


def value_with_share_text(value: Column, percent: Column, digits: int = 4) -> Column:
    """A number with its percentage in brackets."""
    return F.format_string(f"%.{digits}f (%.1f%%)", value, percent)


def month_text(month: Column) -> Column:
    """Three-letter name of a month number."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMM")


def bucket_colour(bucket: Column) -> Column:
    """Display colour of a severity bucket."""
    colours = F.create_map(*[F.lit(x) for pair in BUCKETS.items() for x in pair])
    return F.coalesce(F.try_element_at(colours, bucket), F.lit(OTHER_COLOUR))


def at_least_zero(value: Column) -> Column:
    return F.greatest(F.lit(0.0), value)


def one_if_zero(value: Column) -> Column:
    """The value, or one where it is zero or missing, as a divisor."""
    return F.when(value != 0, value).otherwise(F.lit(1.0))


def utc_text(moment: Column) -> Column:
    """Moment as ISO text in UTC."""
    utc = F.to_utc_timestamp(moment, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
