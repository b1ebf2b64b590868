"""Constraint checks. Each rule gives the rows that break it as (rule, key, rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _finding(df: DataFrame, rule: str, keys: list[str], count: Column) -> DataFrame:
    key = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    return df.select(F.lit(rule).alias("rule"), key.alias("key"), count.cast("bigint").alias("rows"))


def unique(df: DataFrame, rule: str, *keys: str) -> DataFrame:
    """Values that occur more than once. A row with a NULL among the keys repeats nothing."""
    repeated = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return _finding(repeated, rule, list(keys), F.col("n"))


def primary_key(df: DataFrame, rule: str, *keys: str) -> DataFrame:
    """Keys that occur more than once, and keys with a NULL, which shows as `NULL`."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    broken = df.groupBy(*keys).agg(F.count("*").alias("n")).where((F.col("n") > 1) | missing)
    shown = broken.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys})
    return _finding(shown, rule, list(keys), F.col("n"))


def references(df: DataFrame, rule: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values without a parent; NULL refers to nothing and is allowed."""
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias(column))
    return _finding(values.join(known, column, "left_anti"), rule, [column], F.col("n"))


def present(df: DataFrame, rule: str, column: str, *keys: str) -> DataFrame:
    return _finding(df.where(F.col(column).isNull()), rule, list(keys), F.lit(1))


def check(df: DataFrame, rule: str, condition: Column, *keys: str) -> DataFrame:
    """Rows where the condition is false; an unknown condition passes."""
    return _finding(df.where(~condition), rule, list(keys), F.lit(1))


def violations(*findings: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)
