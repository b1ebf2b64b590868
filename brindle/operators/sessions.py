"""Questions about the recent past of a key, without a window over all its rows.

Time is cut into buckets as wide as the horizon. Two events of one bucket are
then closer than the horizon, and an event further back than the bucket before is
out of reach. So a few numbers per (key, bucket) answer everything, and they are
combined before the shuffle however many events a key has. A window over the
buckets of a key is as long as the time covered, not as the events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.dates import epoch_micros


def _buckets(df: DataFrame, key: str, ts: str, identity: str, seconds: int) -> DataFrame:
    at = epoch_micros(F.col(ts))
    return (
        df.select(key, F.col(identity).alias("_id"), at.alias("_at"))
        .groupBy(key, F.floor(F.col("_at") / F.lit(seconds * 1_000_000)).cast("bigint").alias("_bucket"))
        .agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count("*").alias("_n"),
             F.min_by("_id", F.struct("_at", "_id")).alias("_first_id"))
    )


def first_sightings(df: DataFrame, key: str, ts: str, identity: str, seconds: int) -> DataFrame:
    """Ids of events with no event of the same key in the `seconds` before."""
    line = Window.partitionBy(key).orderBy("_bucket")
    buckets = _buckets(df, key, ts, identity, seconds).withColumn("_before", F.lag("_last").over(line))
    fresh = F.col("_before").isNull() | (F.col("_first") - F.col("_before") > seconds * 1_000_000)
    return buckets.where(fresh).select(F.col("_first_id").alias(identity))


def seen_within(df: DataFrame, key: str, ts: str, identity: str, seconds: int) -> DataFrame:
    """Events whose key had been seen in the `seconds` before."""
    return df.join(first_sightings(df, key, ts, identity, seconds), identity, "left_anti")


def presence(df: DataFrame, key: str, ts: str, identity: str, gap_seconds: int) -> DataFrame:
    """Sessions of a key: events at most `gap_seconds` apart belong together."""
    buckets = _buckets(df, key, ts, identity, gap_seconds)
    line = Window.partitionBy(key).orderBy("_bucket")
    starts = F.col("_first") - F.lag("_last").over(line) > gap_seconds * 1_000_000
    marked = buckets.withColumn("_start", F.coalesce(starts, F.lit(True)).cast("int"))
    marked = marked.withColumn("session", F.sum("_start").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(key, "session").agg(
        F.min("_first").alias("started"), F.max("_last").alias("ended"), F.sum("_n").alias("events")
    )


def online(sessions: DataFrame, as_of_micros: int, gap_seconds: int) -> DataFrame:
    """Sessions that are open at a moment: started, and not ended longer ago than the gap."""
    return sessions.where(
        (F.col("started") <= as_of_micros) & (F.col("ended") >= as_of_micros - gap_seconds * 1_000_000)
    )
