"""Counters and leaderboards kept over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.operators.keyspace import last_write, leaderboard
from brindle.streaming.runner import drained


def counters(changes: DataFrame, home: str | None = None) -> DataFrame:
    """Totals per (key, field) of a stream of increments.

    Each micro-batch writes only the totals it changed; the newest one counts.
    """
    totals = changes.groupBy("key", "field").agg(F.sum("delta").alias("value"), F.count("*").alias("writes"))
    changed = drained(totals, mode="update", home=home)
    newest = changed.withColumn("now", F.struct("value", "writes"))
    return last_write(newest, ["key", "field"], "now", "batch").select("key", "field", "now.value", "now.writes")


def live_leaderboard(changes: DataFrame, top: int, home: str | None = None) -> DataFrame:
    """The best members per key after the last micro-batch.

    Each micro-batch writes only the scores it changed; the newest ones are ranked.
    """
    scores = changes.groupBy("key", "member").agg(F.sum("delta").alias("score"))
    changed = drained(scores, mode="update", home=home)
    return leaderboard(last_write(changed, ["key", "member"], "score", "batch"), top)
