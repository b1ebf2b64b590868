"""Channel subscriptions: messages(seq, channel, data, ts)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from threading import Event

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.text import key_like, part_of
from brindle.streaming.runner import drain, home_of, stored, to_batches

STOP = "KILL"  # fixed value: the message that ends a consumer


def subscribe(messages: DataFrame, channels: Sequence[str] = (), patterns: Sequence[str] = (), since: str | None = None) -> DataFrame:
    """Messages of the named channels and channel patterns; the others are dropped.

    There is no retention: what came before `since` is not seen.
    """
    wanted = [F.col("channel").isin(list(channels))] if channels else []
    wanted += [key_like(F.col("channel"), p) for p in patterns]
    heard = messages.where(reduce(lambda a, b: a | b, wanted))
    return heard if since is None else heard.where(F.col("ts") >= F.lit(since).cast("timestamp"))


def split_fields(messages: DataFrame, *names: str, mark: str = ":") -> DataFrame:
    """Fields of a delimited message text as columns."""
    return messages.withColumns({name: part_of(F.col("data"), i, mark) for i, name in enumerate(names)})


def until_stop(messages: DataFrame, stop: str = STOP) -> DataFrame:
    """Messages of a batch before the first stop message."""
    end = messages.where(F.col("data") == stop).agg(F.min("seq").alias("seq")).scalar()
    return messages.where(end.isNull() | (F.col("seq") < end))


def consume(
    messages: DataFrame, work: Callable[[DataFrame], DataFrame], stop: str = STOP, home: str | None = None, live: bool = False
) -> DataFrame:
    """Apply `work` to each micro-batch until a stop message, which ends the query; later ones stay unseen."""
    spark, home = messages.sparkSession, home_of(messages, home)
    path, stops = f"{home}/out", f"{home}/stops"
    store, note = to_batches(path), to_batches(stops)
    stopped = Event()

    def handle(batch: DataFrame, number: int) -> None:
        # The batch where the consumer stopped is kept on disk, for a restart.
        if stopped.is_set() or (number > 0 and not spark.read.parquet(stops).where(F.col("batch") < number).isEmpty()):
            stopped.set()
            return
        end = batch.where(F.col("data") == stop).agg(F.min("seq").alias("seq")).where(F.col("seq").isNotNull())
        store(work(until_stop(batch, stop)), number)
        note(end, number)
        if not spark.read.parquet(f"{stops}/batch={number}").isEmpty():
            stopped.set()

    drain(messages, handle, home=home, stopped=stopped.is_set, live=live)
    return stored(spark, path, work(spark.createDataFrame([], messages.schema)))
