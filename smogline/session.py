"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Settings that hold at any size. Partition counts start high and AQE merges
# the small ones; skewed join partitions are split.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# On top of these, for a cluster reading tens of terabytes.
CLUSTER_SETTINGS = {
    **SETTINGS,
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def local_session(name: str = "smogline", cpus: str | int = "*", memory: str = "8g") -> SparkSession:
    """A session in this process, for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    partitions = "8" if cpus == "*" else str(cpus)
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": partitions,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, besides ``--py-files``."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["OPENBLAS_NUM_THREADS"] = "1"  # tasks share the cores already
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


#: Bytes of an Arrow batch between a task and its Python worker.
BATCH_BYTES = 1 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes: rows that hold whole blocks fill the default of 64 MB.

    A task keeps several copies of a batch outside the heap, and its worker some more.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, from ``spark.checkpoint.dir``.

    Only a session whose executors live in this process may fall back on a
    temporary folder; on a cluster an unset folder is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="smogline-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def staged_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}"


def stage(df: DataFrame, name: str, compression: str | None = None, **options: str) -> DataFrame:
    """Write the table to the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives later plans a
    columnar scan with real size statistics. Tables go under the application's
    id, so that its folder can be removed as a whole afterwards. ``compression``
    is the codec of the files, if not the session's; ``options`` are those of the writer.
    """
    spark = df.sparkSession
    path = staged_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.mode("overwrite").options(**options).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}


def small_table(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """A few driver-side rows as a table, planned as literals.

    Built from Arrow columns, so that no Python worker has to unpickle rows.
    """
    arrays = [pa.array([r[k] for r in rows], _ARROW[t]) for k, t in enumerate(columns.values())]
    return spark.createDataFrame(pa.table(arrays, names=list(columns)))
