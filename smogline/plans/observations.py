"""Observation rows derived from the order tables of the test data.

Constants are doubles, so that another engine computes the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.operators.clean import clean
from smogline.schema import BUCKET, DATE, INDEX, PLACE, POLLUTANTS
from smogline.session import stage

# A measurement is missing where the row number divides by this.
GAPS = {
    "PM2_5": 13, "PM10": 5, "NO": 17, "NO2": 19, "NOx": 23, "NH3": 3,
    "O3": 37, "Toluene": 7, "Xylene": 2, "AQI": 29, "AQI_Bucket": 31,
}
COPIED = 50
# So many sellers, of some 40 bytes each, are sent to every task; more are joined by a shuffle.
FEW_SELLERS = 1_000_000


def spread(df: DataFrame, scan: DataFrame) -> DataFrame:
    """Share out a table that is scanned in fewer splits than there are cores; leave any other.

    A split is at most ``spark.sql.files.maxPartitionBytes`` of a file, so only a
    scan below cores x that size is shared out, however few its files are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if scan.rdd.getNumPartitions() < cores else df


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Raw observations with gaps and copies, one row per order line.

    The chain joins small sides to each other first, so that the lines are
    shuffled only once per key. Spark's own bound for a broadcast is by bytes
    of files, and lines are far wider than sellers, so up to ``FEW_SELLERS``
    sellers are broadcast; no other side is forced to be.
    """

    def table(name: str, *columns: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)

    placed = table("orders", "o_orderkey", "o_custkey", "o_totalprice").join(
        table("customer", "c_custkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey")
    )
    sellers = table("supplier", "s_suppkey", "s_nationkey", "s_acctbal").join(
        table("nation", "n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    if table("supplier", "s_suppkey").count() <= FEW_SELLERS:  # from the files' footers
        sellers = F.broadcast(sellers)
    scanned = table(
        "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    )
    lines = (
        scanned.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part", "p_partkey", "p_size", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    key = F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_suppkey") * 7 + F.col("l_linenumber")
    full = lines.select(
        F.col("n_name").alias(PLACE),
        F.col("l_shipdate").cast("date").alias(DATE),
        key.alias("k"),
        (F.col("l_quantity") * 9.0).alias("PM2_5"),
        (F.col("l_extendedprice") / 300.0).alias("PM10"),
        (F.col("p_size") * 1.0).alias("NO"),
        (F.col("l_discount") * 1000.0 + 0.0).alias("NO2"),
        (F.col("l_tax") * 500.0 + 0.0).alias("NH3"),
        ((key % 211) / 10.0).alias("CO"),
        (F.col("p_retailprice") - 900.0).alias("SO2"),
        (F.col("o_totalprice") / 4000.0).alias("O3"),
        ((F.col("c_acctbal") + 1000.0) / 1000.0).alias("Benzene"),
        ((F.col("s_acctbal") + 1000.0) / 500.0).alias("Toluene"),
        (F.col("l_linenumber") * 1.0).alias("Xylene"),
    ).withColumn("NOx", F.col("NO2") * 0.6 + F.col("NO") * 0.8)
    worst = F.greatest("PM2_5", "PM10", F.col("NO2") * 1.2, F.col("SO2"))
    scored = full.withColumn(INDEX, F.floor(worst + F.col("O3") * 0.1).cast("double"))
    # The upper ends of the public index bands.
    bucket = (
        F.when(F.col(INDEX) <= 50, "Good")
        .when(F.col(INDEX) <= 100, "Satisfactory")
        .when(F.col(INDEX) <= 200, "Moderate")
        .when(F.col(INDEX) <= 300, "Poor")
        .when(F.col(INDEX) <= 400, "Very Poor")
        .otherwise("Severe")
    )
    named = scored.withColumn(BUCKET, bucket)
    with_gaps = named.withColumns({c: F.when(F.col("k") % m != 0, F.col(c)) for c, m in GAPS.items()})
    times = F.when(F.col("k") % COPIED == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = with_gaps.withColumn("copy", F.explode(times)).select(
        PLACE, DATE, "k", *POLLUTANTS, INDEX, BUCKET
    )
    return spread(rows, scanned)


_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def once(kind: str, spark: SparkSession, folder: str, build) -> DataFrame:
    """Stage a table once per application; queries then scan the files.

    These tables are as long as the input, so they are packed tighter than others.
    """
    where = (spark.sparkContext.applicationId, folder, kind)
    if where not in _STAGED:
        _STAGED[where] = stage(build(), kind, "zstd")
    return _STAGED[where]


def staged_observations(spark: SparkSession, folder: str) -> DataFrame:
    return once("observations", spark, folder, lambda: observations(spark, folder))


def staged_clean(spark: SparkSession, folder: str) -> DataFrame:
    return once("clean", spark, folder, lambda: clean(staged_observations(spark, folder)))
