"""Sessions over streams that come late and out of order, kept in Spark's own event-time state.

Events of a key at most `gap` seconds apart belong to one session. The state holds one row per open session: an event
extends one, begins one or joins two, whatever order events come in. A session is final, is emitted and leaves the state
when the watermark, the newest time seen less `delay` seconds, has passed its end and the gap. So events that are late by
up to `delay` give the same result in any order; later ones are dropped, at the latest from the second micro-batch on. To close the last sessions of a channel
that falls silent, send a message with a NULL key and a time beyond (`heartbeat`).

Sessions are merged inside each task before they are shuffled, so a hot key costs a row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.streaming.runner import drained

MERGE_FIRST = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def _sessions(events: DataFrame, keys: Sequence[str], ts: str, gap: int, delay: int, *found: Column) -> DataFrame:
    """Closed sessions of all keys, NULL too, with the aggregates `found`."""
    events.sparkSession.conf.set(MERGE_FIRST, "true")
    # A window reaches to just before its end; an event exactly `gap` later still belongs to the session.
    window = F.session_window("_at", F.lit(f"{gap * 1_000_000 + 1} microseconds"))
    timed = events.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", f"{delay} seconds")
    return timed.groupBy(window.alias("_window"), *keys).agg(*found).drop("_window")


def _emitted(found: DataFrame, keys: Sequence[str], home: str | None) -> DataFrame:
    """What was emitted, without heartbeats. A filter before the watermark would keep them from moving it."""
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return drained(found, shape=lambda batch: batch.where(known), home=home).drop("batch")


def heartbeat(spark: SparkSession, like: DataFrame, ts: str, at: Column) -> DataFrame:
    """One row like those of `like`, with the time `at` and all else NULL."""
    return spark.range(1).select(*[(at if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def presence(events: DataFrame, key: str, ts: str, gap: int, delay: int, home: str | None = None) -> DataFrame:
    """Closed sessions of each key: when they started and ended (microseconds), and their number of events."""
    at = F.unix_micros("_at")
    found = _sessions(events, [key], ts, gap, delay, F.min(at).alias("started"), F.max(at).alias("ended"), F.count("*").alias("events"))
    return _emitted(found, [key], home)


def fresh_within(events: DataFrame, keys: Sequence[str], ts: str, identity: str, horizon: int, delay: int, home: str | None = None) -> DataFrame:
    """Events whose key was not seen in the `horizon` seconds before: the first of each session.

    Of events at the same time the one with the smallest `identity` counts as first. Emitted when its session is final.
    """
    rest = [c for c in events.columns if c not in (ts, identity, *keys)]
    first = F.min_by(F.struct(*[F.col(c) for c in (identity, ts, *rest)]), F.struct("_at", identity)).alias("_first")
    found = _sessions(events, keys, ts, horizon, delay, first)
    return _emitted(found.select(*keys, "_first.*").select(*events.columns), keys, home)
