"""Column names, types and the severity domain of an observation table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogline.session import small_table

# The measured columns, in table order. A dot in a name breaks
# Spark ML, so the column written "PM2.5" in files is PM2_5 inside.
POLLUTANTS = [
    "PM2_5", "PM10", "NO", "NO2", "NOx", "NH3",
    "CO", "SO2", "O3", "Benzene", "Toluene", "Xylene",
]
FILE_NAMES = {"PM2_5": "PM2.5"}

PLACE = "City"
DATE = "Date"
INDEX = "AQI"
BUCKET = "AQI_Bucket"
TARGETS = [INDEX, BUCKET]
CORRELATED = [*POLLUTANTS, INDEX]

CALENDAR = ["Year", "Month", "Day", "DayOfWeek", "Quarter", "DayOfYear", "IsWeekend"]
PLACE_CODE = "City_Encoded"
FEATURES = [*POLLUTANTS, *CALENDAR, PLACE_CODE]

# The buckets from mild to severe, each with its display colour,
# and the colour of a bucket outside the list.
BUCKETS = {
    "Good": "#2ecc71",
    "Satisfactory": "#a8e063",
    "Moderate": "#f1c40f",
    "Poor": "#e67e22",
    "Very Poor": "#e74c3c",
    "Severe": "#8e44ad",
}
OTHER_COLOUR = "#95a5a6"

# Cell texts that stand for a missing value in a delimited file.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

OBSERVATION = T.StructType(
    [T.StructField(PLACE, T.StringType()), T.StructField(DATE, T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in POLLUTANTS]
    + [T.StructField(INDEX, T.DoubleType()), T.StructField(BUCKET, T.StringType())]
)


# The metrics file: one object per task.
TASKS = ["regression", "classification"]
_TASK = (
    "struct<models: map<string, map<string, double>>, best_model: string, "
    "best_metrics: map<string, double>>"
)
METRICS = "generated_at string, " + ", ".join(f"{task} {_TASK}" for task in TASKS)


def file_name(column: str) -> str:
    """Name of a column at a file or report edge."""
    return FILE_NAMES.get(column, column)


def inner_name(column: str) -> str:
    """Name of a file column inside the library."""
    return {v: k for k, v in FILE_NAMES.items()}.get(column, column)


def present(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of the columns that the table has."""
    return [c for c in columns if c in df.columns]


def bucket_domain(spark: SparkSession) -> DataFrame:
    """The six buckets as a table (bucket, ord, colour)."""
    rows = [(b, i, colour) for i, (b, colour) in enumerate(BUCKETS.items())]
    return small_table(spark, rows, {BUCKET: "string", "ord": "int", "colour": "string"})


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of a missing number: NULL."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats})


def missing_text_to_null(column: str) -> Column:
    return F.when(~F.col(f"`{column}`").isin(MISSING_TEXTS), F.col(f"`{column}`"))
