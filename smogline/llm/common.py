"""Helpers shared by the operators on texts."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline import session

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Code points and bytes that separate words: space, tab, line feed, vertical tab, form feed, return.
BLANK = " \t\n\x0b\x0c\r"


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, besides ``--py-files``."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["OPENBLAS_NUM_THREADS"] = "1"  # tasks share the cores already
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``session.stage`` that removes the shuffle files behind a table as soon as it is written.

    Nothing reads them again, and else they stay until the driver collects its garbage.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return session.stage(df, name, compression)
    finally:
        conf.set(key, before) if before is not None else conf.unset(key)


def fresh(df: DataFrame, name: str) -> str:
    """The name, with underscores behind it until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` only, whatever else the table holds; a missing text is empty."""
    reachable(docs.sparkSession)
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def fold(text: str) -> bytes:
    """UTF-8 of the text with A-Z in lower case; ``bytes.lower`` touches ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower()


def words_of(text: str) -> list[bytes]:
    """Words between blanks, A-Z in lower case; ``bytes.split`` parts at the six blanks only."""
    return fold(text).split()


def parts_for(df: DataFrame, text_col: str, target_bytes: int, most: int = 20_000) -> int:
    """Number of parts of about ``target_bytes`` of text, from the size of all texts."""
    total = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return int(min(most, total // target_bytes + 1))
