"""Text files as DataFrames. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header line. A byte-order mark is dropped and `NA` stays a text."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def read_csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """CSV as text columns `_c0`, `_c1`, ...; a header line is a row like any other."""
    return spark.read.option("escape", '"').csv(path)


def read_json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document per file, with the file's path in `source`."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn(
        "source", F.col("_metadata.file_path")
    )


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All JSON files of a folder as one table, a record per line."""
    return spark.read.schema(schema).json(path)


def record_set(df: DataFrame, column: str, record: str) -> DataFrame:
    """Rows from a text column that holds a JSON array of records."""
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.inline(F.from_json(column, f"array<struct<{record}>>")))


def merge_arrays(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Parallel arrays, each from whichever document has it, as rows by position."""
    rows = None
    for name in columns:
        one = df.where(F.col(name).isNotNull()).select(F.posexplode(name).alias("pos", name))
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    return rows.groupBy("pos").agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns])
