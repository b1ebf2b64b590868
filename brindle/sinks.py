"""Writes: whole-family replacement, appends, text files.

A family of tables is published by version. Every table of a version is written
first; a one-row pointer file written last makes the version the current one, so
a reader sees the old family or the new one and never a mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.session import fresh_path, remove


def replace_all(
    spark: SparkSession, tables: dict[str, DataFrame], base: str | None = None, keep: int = 2
) -> dict[str, DataFrame]:
    """Write all tables as one new version and make it current; of older versions the last `keep` - 1 stay."""
    base = base or fresh_path(spark, "family")
    version = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{base}/{version}/{name}")
    pointer = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("at"))
    pointer.coalesce(1).write.mode("append").parquet(f"{base}/current")
    prune(spark, base, keep)
    return read_current(spark, base, list(tables))


def prune(spark: SparkSession, base: str, keep: int) -> None:
    """Remove all versions but the newest `keep`, with their pointers: first the pointer, then what it names."""
    pointers = spark.read.parquet(f"{base}/current").select("version", "at", F.input_file_name().alias("file"))
    for row in pointers.orderBy(F.col("at").desc()).collect()[max(1, keep):]:
        remove(spark, row.file)
        remove(spark, f"{base}/{row.version}")


def read_current(spark: SparkSession, base: str, names: list[str]) -> dict[str, DataFrame]:
    """The tables of the version published last."""
    newest = spark.read.parquet(f"{base}/current").agg(F.max_by("version", "at").alias("version")).first()
    return {name: spark.read.parquet(f"{base}/{newest.version}/{name}") for name in names}


def empty_all(spark: SparkSession, base: str, names: list[str]) -> dict[str, DataFrame]:
    """Publish a version in which every table is empty."""
    return replace_all(spark, {n: df.limit(0) for n, df in read_current(spark, base, names).items()}, base)


def append(df: DataFrame, path: str) -> DataFrame:
    """Create the table if it is absent and add the rows."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_interval(df: DataFrame, path: str, start: int) -> None:
    """Store the rows of one interval; a second run of it replaces the first."""
    df.write.mode("overwrite").parquet(f"{path}/interval={start}")


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header line and no index column."""
    # Without escaping of the quote mark by itself, texts that hold quotes do not come back.
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.json(path)
    return path
