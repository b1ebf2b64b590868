"""Key-value lists of any length as long tables.

list(key, pos, sub, item): items are in order of `pos`, then `sub`. Pushing to the
left counts `pos` down, to the right up; nothing that is there has to move. For
lists that fit a row, see `brindle.functions.arrays`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.ordering import range_by_index, row_numbers
from brindle.operators.skew import plain_side


def _order() -> list[Column]:
    return [F.col("pos"), F.col("sub")]


def from_pushes(log: DataFrame) -> DataFrame:
    """Lists from a log(seq, op, key, item) of `lpush` and `rpush`; `seq` counts from 1."""
    pos = F.when(F.col("op") == "lpush", -F.col("seq")).otherwise(F.col("seq"))
    return log.select("key", pos.cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("sub"), "item")


def lengths(lists: DataFrame) -> DataFrame:
    return lists.groupBy("key").agg(F.count("*").alias("size"))


def item_range(lists: DataFrame, start: int, stop: int) -> DataFrame:
    """Items `start`..`stop`, inclusive and from 0, negatives from the end, with their `position`."""
    return range_by_index(lists, ["key"], _order(), start, stop)


def insert_before(lists: DataFrame, inserts: DataFrame) -> DataFrame:
    """Put an item before the first `pivot` of its list; no pivot, no change.

    `inserts`(key, pivot, item) has one row per key.
    """
    wanted = inserts.select("key", F.col("pivot").alias("item"), F.col("item").alias("_new"))
    first = (
        lists.join(plain_side(wanted), ["key", "item"])
        .groupBy("key", F.col("_new")).agg(F.min(F.struct("pos", "sub")).alias("_at"))
    )
    # Doubling `sub` leaves room for the new item before its neighbour; then the lists are numbered again.
    spread = lists.select("key", "pos", (F.col("sub") * 2).alias("sub"), "item")
    added = first.select("key", F.col("_at.pos").alias("pos"), (F.col("_at.sub") * 2 - 1).alias("sub"), F.col("_new").alias("item"))
    placed = row_numbers(spread.unionByName(added), ["key"], _order(), "_place")
    return placed.select("key", F.col("_place").alias("pos"), F.lit(0).cast("bigint").alias("sub"), "item")


def pop(lists: DataFrame, left: bool = True) -> tuple[DataFrame, DataFrame]:
    """Take one item from an end of every list: the items taken, and the lists that remain."""
    place = F.struct("pos", "sub", "item")
    end = F.min(place) if left else F.max(place)
    taken = plain_side(lists.groupBy("key").agg(end.alias("_end")).select("key", "_end.*"))
    rest = lists.join(taken.select("key", "pos", "sub"), ["key", "pos", "sub"], "left_anti")
    return taken.select("key", "item"), rest
