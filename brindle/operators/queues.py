"""Replay of lists of any length: pushes and pops at both ends, with the item that every pop takes.

A list is a tape of numbered slots with a left and a right end. A push moves its end outwards and writes a slot, a pop
reads a slot and moves its end back; so both ends are running totals, and a pop takes what was last written to its slot.
Pops on an empty list take nothing: they are those at which the running balance of pushes and pops falls below all its
earlier values. Balance, lowest balance and ends are worked out slab by slab (see `ordering`), so a hot list is spread
over many tasks, and only one row per (list, slab) crosses between them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.operators.ordering import _KEY, SLAB, in_slabs, previous, running_total
from brindle.session import materialize

PUSHES, POPS = ("lpush", "rpush"), ("lpop", "rpop")
CLEAR = "clear"


def _op(*names: str) -> Column:
    return F.col("op").isin(*names)


def _later(slabs: DataFrame, by: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """What earlier slabs of a key add up to: the columns of `totals`, 0 at the first slab."""
    earlier = Window.partitionBy(*by).orderBy(SLAB).rowsBetween(Window.unboundedPreceding, -1)
    sums = slabs.groupBy(*by, SLAB).agg(*[c.alias(name) for name, c in totals.items()])
    return sums.select(*by, SLAB, *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_from_{name}") for name in totals], *totals)


def _with_epochs(log: DataFrame, on: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """After a `clear` a list is another one: `_epoch` counts them."""
    if log.where(_op(CLEAR)).isEmpty():
        return log, list(on)
    counted = running_total(log, on, [F.col("seq")], F.when(_op(CLEAR), 1).otherwise(0).cast("bigint"), "_epoch")
    return counted.where(~_op(CLEAR)), [*on, "_epoch"]


def placed(log: DataFrame, on: Sequence[str] = ("key",)) -> DataFrame:
    """A log(seq, op, *on, item) of `lpush`, `rpush`, `lpop`, `rpop` and `clear` with the `slot` of each command.

    Pops that find nothing have a NULL slot; `clear` empties a list and is left out. `seq` tells commands apart. Other
    commands are an error. Written once, for `taken` and `remaining`.
    """
    known = F.when(_op(*PUSHES, *POPS, CLEAR), F.col("op")).otherwise(F.raise_error(F.concat(F.lit("no list command: "), F.coalesce("op", F.lit("NULL")))))
    log, keys = _with_epochs(log.withColumn("op", known), on)
    slabs, by = in_slabs(log.withColumn("_step", F.when(_op(*PUSHES), 1).otherwise(-1).cast("bigint")), keys, [F.col("seq")])

    upto = Window.partitionBy(*by, SLAB).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by, SLAB).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    balanced = slabs.withColumn("_sum", F.sum("_step").over(upto)).withColumn("_low", F.min("_sum").over(before))
    lows = balanced.groupBy(*by, SLAB).agg(F.sum("_step").alias("_total"), F.min("_sum").alias("_least"))
    earlier = Window.partitionBy(*by).orderBy(SLAB).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        lows.withColumn("_start", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
        .withColumn("_floor", F.least(F.coalesce(F.min(F.col("_start") + F.col("_least")).over(earlier), F.lit(0)), F.lit(0)))
        .select(*by, SLAB, "_start", "_floor")
    )
    lowest = F.least(F.col("_floor"), F.col("_start") + F.coalesce("_low", F.lit(0)))
    finds = _op(*PUSHES) | (F.col("_start") + F.col("_sum") >= lowest)
    # The first low of a slab is 0 above its start, which is no lower than the floor by then.
    rows = balanced.join(starts, [*by, SLAB]).withColumn("_finds", finds).drop("_step", "_sum", "_low", "_start", "_floor")

    step = {
        "_left": F.when(F.col("_finds") & _op("lpush"), -1).when(F.col("_finds") & _op("lpop"), 1).otherwise(0).cast("bigint"),
        "_right": F.when(F.col("_finds") & _op("rpush"), 1).when(F.col("_finds") & _op("rpop"), -1).otherwise(0).cast("bigint"),
    }
    rows = rows.withColumns(step)
    ends = _later(rows, by, {"_l": F.sum("_left"), "_r": F.sum("_right")}).select(*by, SLAB, "_from__l", "_from__r")
    moved = rows.join(ends, [*by, SLAB]).withColumns(
        {"_left": F.col("_from__l") + F.sum("_left").over(upto), "_right": F.col("_from__r") + F.sum("_right").over(upto)}
    )
    slot = (
        F.when(_op("lpush"), F.col("_left")).when(_op("lpop"), F.col("_left") - 1)
        .when(_op("rpush"), F.col("_right") - 1).otherwise(F.col("_right"))
    )
    return materialize(moved.withColumn("slot", F.when(F.col("_finds"), slot)).select("seq", "op", *keys, "item", "slot"), "placed")


def _keys(tape: DataFrame) -> list[str]:
    return [c for c in tape.columns if c not in ("seq", "op", "item", "slot")]


def taken(tape: DataFrame) -> DataFrame:
    """Every pop with the item it takes, NULL if the list was empty: seq, op, the list's key, item."""
    keys = _keys(tape)
    found = previous(tape.where(F.col("slot").isNotNull()), [*keys, "slot"], [F.col("seq")], "item", "_taken")
    pops = found.where(_op(*POPS)).withColumn("item", F.col("_taken")).drop("_taken", _KEY)
    nothing = tape.where(F.col("slot").isNull()).withColumn("item", F.lit(None).cast("string"))
    return pops.unionByName(nothing).drop("slot", "_epoch")


def remaining(tape: DataFrame) -> DataFrame:
    """What the lists hold in the end: the list's key, `pos` and `sub` (its order, see `lists`), item."""
    keys = _keys(tape)
    if "_epoch" in keys:
        keys.remove("_epoch")
        newest = tape.groupBy(*keys).agg(F.max("_epoch").alias("_newest"))
        same = [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in keys]
        at = newest.select(*[F.col(k).alias(f"_at_{k}") for k in keys], "_newest")
        tape = tape.join(at, [*same, F.col("_epoch") == F.col("_newest")]).select("seq", "op", *keys, "item", "slot")
    last = tape.where(F.col("slot").isNotNull()).groupBy(*keys, "slot").agg(F.max_by(F.struct("op", "item"), "seq").alias("_now"))
    return last.where(F.col("_now.op").isin(*PUSHES)).select(*keys, F.col("slot").alias("pos"), F.lit(0).cast("bigint").alias("sub"), F.col("_now.item").alias("item"))
