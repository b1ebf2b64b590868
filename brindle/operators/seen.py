"""Sets of seen values for very many questions: Bloom filters beside the set, and an exact check of what they let through.

The filter of a part of the set is a row per 64 bits that are set, so it is made by sums and asked by a join on the part
and the word: what is asked is shuffled, the set is not. A value with a bit that is not set was surely never seen. The
others, about one in a hundred of those never seen with the default of ten bits a value, are looked up in the parts of
the set they could lie in, and only these are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.skew import plain_side

BITS_PER_VALUE = 10
HASHES = 7


@dataclass(frozen=True)
class Seen:
    """Where a stored set lies, in how many parts, with how many bits to the filter of each."""

    base: str
    column: str
    parts: int
    bits: int


def _part(column: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


def _bits(column: str, bits: int) -> Column:
    """Places of a value in its part's filter: two hashes and their sums."""
    a, b = F.xxhash64(F.lit(1), column), F.xxhash64(F.lit(2), column)
    return F.array(*[F.pmod(F.shiftright(a, 1) + F.shiftright(b, 8) * i, F.lit(bits)) for i in range(HASHES)])


def store(values: DataFrame, column: str, base: str, parts: int) -> Seen:
    """Store the distinct values of a column that are not NULL, with their filters."""
    rows = values.select(column).where(F.col(column).isNotNull()).distinct().withColumn("part", _part(column, parts))
    rows.repartition(parts, "part").write.partitionBy("part").parquet(f"{base}/values")
    kept = values.sparkSession.read.schema(rows.schema).parquet(f"{base}/values")
    bits = max(64, BITS_PER_VALUE * kept.count() // parts)
    words = kept.select("part", F.explode(_bits(column, bits)).alias("_bit")).groupBy("part", F.floor(F.col("_bit") / 64).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))")).alias("mask")
    )
    words.write.parquet(f"{base}/filter")
    return Seen(base, column, parts, bits)


def maybe(seen: Seen, asked: DataFrame, column: str) -> DataFrame:
    """Distinct asked values that the filters do not rule out, with their part."""
    values = asked.select(F.col(column).alias("_value")).where(F.col("_value").isNotNull()).distinct()
    bits = values.select("_value", _part("_value", seen.parts).alias("part"), F.explode(_bits("_value", seen.bits)).alias("_bit"))
    words = asked.sparkSession.read.parquet(f"{seen.base}/filter").select("part", F.col("word").alias("_word"), "mask")
    at = bits.withColumn("_word", F.floor(F.col("_bit") / 64))
    hit = at.join(words, ["part", "_word"]).where(F.expr("bit_get(mask, cast(_bit % 64 as int)) = 1"))
    return hit.groupBy("_value", "part").agg(F.count("*").alias("_hits")).where(F.col("_hits") == HASHES).select("_value", "part")


def known(seen: Seen, asked: DataFrame, column: str) -> DataFrame:
    """Distinct asked values that were seen."""
    candidates = plain_side(maybe(seen, asked, column))
    parts = [r.part for r in candidates.select("part").distinct().collect()]
    values = asked.sparkSession.read.parquet(f"{seen.base}/values").where(F.col("part").isin(parts))
    same = (values[seen.column] == candidates["_value"]) & (values["part"] == candidates["part"])
    return candidates.join(values, same, "left_semi").select(F.col("_value").alias(column))


def split(seen: Seen, asked: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The asked rows whose value was seen, and the others, NULL among them."""
    found = plain_side(known(seen, asked, column))
    return asked.join(found, column, "left_semi"), asked.join(found, column, "left_anti")
