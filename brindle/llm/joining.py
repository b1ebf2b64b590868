"""Joins of whole texts with findings about some of them, in which only the texts concerned are shuffled.

The ids of the findings are hashed into a bitmap of fixed size, which is broadcast. A text whose bit is not set has no
findings and stays where it is; the others, few more than those with findings, are joined by id. With very many
findings the bitmap fills up and more texts are shuffled; the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23  # of the bitmap: at most BITS / 64 rows are broadcast


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (a hash of the text) and the whole row as the struct `row`, so that no column of it can clash."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def _bit(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BITS))


def _flagged(rows: DataFrame, found: DataFrame, column: str) -> DataFrame:
    bits = found.select(_bit(column).alias("_bit"))
    bitmap = bits.groupBy(F.floor(F.col("_bit") / 64).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))")).alias("_mask")
    )
    at = rows.withColumn("_bit", _bit(column)).withColumn("_at", F.floor(F.col("_bit") / 64))
    flag = F.coalesce(F.expr("bit_get(_mask, cast(_bit % 64 as int)) = 1"), F.lit(False))
    return at.join(F.broadcast(bitmap), F.col("_at") == F.col("_word"), "left").withColumn("_maybe", flag)


def split_by(rows: DataFrame, found: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The rows that may have a finding with their value of `column`, NULL included, and those that have none."""
    flagged = _flagged(rows, found, column)
    return flagged.where("_maybe").select(*rows.columns), flagged.where(~F.col("_maybe")).select(*rows.columns)


def _same(found: DataFrame, column: str, key: str | None) -> tuple[DataFrame, Column]:
    renamed = found.withColumnsRenamed({column: "_id", **({key: "_key"} if key else {})})
    same = F.col(column).eqNullSafe(F.col("_id"))
    return renamed, same & (F.col(key) == F.col("_key")) if key else same


def with_findings(rows: DataFrame, found: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """Inner join on `column`, NULL equal to NULL, and on `key` where both sides have it."""
    renamed, same = _same(found, column, key)
    return split_by(rows, found, column)[0].join(renamed, same).drop("_id", "_key")


def with_findings_or_none(rows: DataFrame, found: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """The same as a left join; columns of `found` are NULL where there is no finding."""
    renamed, same = _same(found, column, key)
    some, none = split_by(rows, found, column)
    joined = some.join(renamed, same, "left").drop("_id", "_key")
    return joined.unionByName(none, allowMissingColumns=True)


def without_findings(rows: DataFrame, found: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """The rows that have no finding."""
    renamed, same = _same(found, column, key)
    some, none = split_by(rows, found, column)
    return some.join(renamed, same, "left_anti").unionByName(none)
