"""Sorted sets stored for questions about few members: score, rank, and ranges of ranks.

The set lies in buckets, each a range of (key, score, member) and a partition of the stored table, beside an index of one
row per bucket and key: its count, its bounds, and how many members of the key come before. A second copy by hash of
(key, member) gives scores. So the rank of a member takes one bucket of each copy, whatever the size of the set; which
buckets these are is known before any is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.operators.skew import plain_side

PLACE = ("score", "member")


@dataclass(frozen=True)
class Ranked:
    """Where a stored sorted set lies, and in how many buckets."""

    base: str
    buckets: int


def _hash_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("key", "member"), F.lit(buckets)).cast("int").alias("bucket")


def store(zset: DataFrame, base: str, buckets: int) -> Ranked:
    """Store zset(key, member, score) in about `buckets` buckets; (key, member) is unique."""
    spark = zset.sparkSession
    rows = zset.select("key", "member", "score")
    spread = rows.repartitionByRange(buckets, "key", *PLACE).withColumn("bucket", F.spark_partition_id())
    spread.sortWithinPartitions("key", *PLACE).write.partitionBy("bucket").parquet(f"{base}/ordered")
    rows.select("*", _hash_bucket(buckets)).repartition(buckets, "bucket").write.partitionBy("bucket").parquet(f"{base}/members")
    ordered = spark.read.schema(_with_bucket(rows)).parquet(f"{base}/ordered")
    place = F.struct(*PLACE)
    parts = ordered.groupBy("key", "bucket").agg(F.count("*").alias("n"), F.min(place).alias("low"), F.max(place).alias("high"))
    line = Window.partitionBy("key").orderBy("bucket")
    parts.withColumn("before", F.sum("n").over(line) - F.col("n")).withColumn("size", F.sum("n").over(Window.partitionBy("key"))).write.parquet(f"{base}/index")
    return Ranked(base, buckets)


def _with_bucket(rows: DataFrame):
    return rows.limit(0).withColumn("bucket", F.lit(0)).schema


def _buckets(spark: SparkSession, ranked: Ranked, copy: str, wanted: DataFrame) -> DataFrame:
    """The named buckets of a copy and no other; there are at most `ranked.buckets` numbers to fetch."""
    numbers = [r.bucket for r in wanted.select("bucket").distinct().collect()]
    return spark.read.parquet(f"{ranked.base}/{copy}").where(F.col("bucket").isin(numbers))


def scores(ranked: Ranked, asked: DataFrame) -> DataFrame:
    """asked(key, member) with the score, NULL where there is none."""
    spark = asked.sparkSession
    asked = plain_side(asked.select("key", "member").distinct().select("*", _hash_bucket(ranked.buckets)))
    found = _buckets(spark, ranked, "members", asked).select("key", "member", "score", "bucket")
    return asked.join(found, ["key", "member", "bucket"], "left").drop("bucket")


def ranks(ranked: Ranked, asked: DataFrame) -> DataFrame:
    """asked(key, member) with score, zero-based `rank` and `revrank`; NULL for members that are not there.

    Ties are in order of the member.
    """
    spark = asked.sparkSession
    known = plain_side(scores(ranked, asked))
    index = spark.read.parquet(f"{ranked.base}/index")
    place = F.struct(*PLACE)
    at = plain_side(known.where("score IS NOT NULL").join(index, "key").where(place.between(F.col("low"), F.col("high"))).drop("low", "high", "n"))
    rows = _buckets(spark, ranked, "ordered", at).select("key", "bucket", place.alias("_place"))
    smaller = at.join(rows, ["key", "bucket"]).where(F.col("_place") < place).groupBy("key", "member").agg(F.count("*").alias("_smaller"))
    found = at.join(smaller, ["key", "member"], "left").withColumn("rank", F.col("before") + F.coalesce("_smaller", F.lit(0)))
    found = found.select("key", "member", "rank", (F.col("size") - 1 - F.col("rank")).alias("revrank"))
    return known.join(found, ["key", "member"], "left")


def rank_range(ranked: Ranked, spark: SparkSession, key: str, start: int, stop: int) -> DataFrame:
    """Members of one key at ranks `start` to `stop` (inclusive, from 0, negatives from the end), with their `rank`."""
    index = spark.read.parquet(f"{ranked.base}/index").where(F.col("key") == key)
    first = F.lit(start) if start >= 0 else F.greatest(F.col("size") + start, F.lit(0))
    last = F.lit(stop) if stop >= 0 else F.col("size") + stop
    parts = plain_side(index.where((F.col("before") <= last) & (F.col("before") + F.col("n") > first)).select("bucket", "before", first.alias("_first"), last.alias("_last")))
    inside = Window.partitionBy("bucket").orderBy(*PLACE)
    rows = _buckets(spark, ranked, "ordered", parts).where(F.col("key") == key).withColumn("_at", F.row_number().over(inside) - 1)
    placed = rows.join(parts, "bucket").withColumn("rank", F.col("before") + F.col("_at"))
    return placed.where(F.col("rank").between(F.col("_first"), F.col("_last"))).select("key", "member", "score", "rank")
