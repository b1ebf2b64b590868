"""Positions, running totals and previous values within a key, for keys of any size.

A window partitioned by key puts all rows of a key into one task. Here the rows
are range-partitioned by key and order instead, so a hot key is spread over many
slabs. Work inside a slab is an ordinary window; what crosses slabs is one small
row per (key, slab).

The slabs are written once, because a second run of the range exchange could
draw other bounds. NULL is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.session import materialize

SLAB, _KEY = "_slab", "_key"


def _struct_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(_KEY, F.struct(*keys))


def in_slabs(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> tuple[DataFrame, list[str]]:
    """The rows with their slab, and the columns to tell keys apart by.

    These are the keys themselves. Only if some are NULL (the files' statistics
    tell) it is a struct of them, in which NULL equals NULL but which is slower.
    """
    spread = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    slabs = materialize(spread.withColumn(SLAB, F.spark_partition_id()), "slabs")
    if not keys or slabs.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).isEmpty():
        return slabs, list(keys)
    return _struct_key(slabs, keys), [_KEY]


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    weight: Column,
    name: str,
    total: str | None = None,
    per_key: DataFrame | None = None,
) -> DataFrame:
    """Add the sum of `weight` over the earlier rows of the same key.

    With `total`, also the sum over all rows of the key. With `per_key`, a table
    that is unique by the keys, also its columns (NULL where a key is missing):
    it is joined to the few rows per slab, not to the rows themselves.
    """
    slabs, by = in_slabs(df.withColumn("_weight", weight), keys, order)
    earlier_slabs = Window.partitionBy(*by).orderBy(SLAB).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slabs.groupBy(*by, SLAB)
        .agg(F.sum("_weight").alias("_slab_weight"))
        .withColumn("_offset", F.coalesce(F.sum("_slab_weight").over(earlier_slabs), F.lit(0)))
    )
    if total is not None:
        offsets = offsets.withColumn(total, F.sum("_slab_weight").over(Window.partitionBy(*by)))
    if per_key is not None:
        facts = per_key if by == list(keys) else _struct_key(per_key, keys).drop(*keys)
        offsets = offsets.join(facts, by, "left")
    offsets = offsets.drop("_slab_weight")
    earlier_rows = Window.partitionBy(*by, SLAB).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        slabs.join(offsets, [*by, SLAB])
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum("_weight").over(earlier_rows), F.lit(0)))
        .drop(_KEY, SLAB, "_offset", "_weight")
    )


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    start: int = 1,
    total: str | None = None,
    per_key: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each key; with no keys, number the whole table.

    `order` should tell rows apart, or equal rows share one slab.
    """
    counted = running_total(df, keys, order, F.lit(1).cast("bigint"), name, total, per_key)
    return counted.withColumn(name, F.col(name) + F.lit(start))


def ranks(df: DataFrame, keys: Sequence[str], value: str, name: str, descending: bool = True) -> DataFrame:
    """Rank with gaps on ties; a NULL value ranks last.

    Ties are counted first, so that many equal values travel as one row. The
    input is written once, because it is read for the ties and for the result.
    """
    df = materialize(df, "ranked")
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    tallies = df.groupBy(*keys, value).agg(F.count("*").alias("_tied"))
    placed = running_total(tallies, keys, [order], F.col("_tied"), name)
    at = {c: f"_at_{c}" for c in (*keys, value)}
    placed = placed.select(*[F.col(c).alias(a) for c, a in at.items()], (F.col(name) + 1).alias(name))
    return df.join(placed, reduce(and_, [F.col(c).eqNullSafe(F.col(a)) for c, a in at.items()])).drop(*at.values())


def previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, name: str
) -> DataFrame:
    """Add `value` of the row before, in key order; NULL on a key's first row."""
    slabs, by = in_slabs(df, keys, order)
    slabs = slabs.withColumn("_value", F.struct(F.col(value).alias("v")))
    inside = Window.partitionBy(*by, SLAB).orderBy(*order)
    numbered = slabs.withColumn("_before", F.lag("_value").over(inside)).withColumn(
        "_is_last", F.lead(F.lit(1)).over(inside).isNull()
    )
    by_slab = Window.partitionBy(*by).orderBy(SLAB)
    carried = (
        numbered.where("_is_last")
        .select(*by, SLAB, F.lag("_value").over(by_slab).alias("_carried"))
    )
    return (
        numbered.join(carried, [*by, SLAB])
        .withColumn(name, F.coalesce("_before", "_carried")["v"])
        .drop(_KEY, SLAB, "_value", "_before", "_carried", "_is_last")
    )


def last_known(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Add the last `value` that is not NULL among a row and those before it, in key order."""
    slabs, by = in_slabs(df, keys, order)
    upto = Window.partitionBy(*by, SLAB).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*by).orderBy(SLAB).rowsBetween(Window.unboundedPreceding, -1)
    here = slabs.withColumn("_here", F.last(value, ignorenulls=True).over(upto)).withColumn(
        "_is_last", F.lead(F.lit(1)).over(Window.partitionBy(*by, SLAB).orderBy(*order)).isNull()
    )
    carried = here.where("_is_last").select(*by, SLAB, F.last("_here", ignorenulls=True).over(earlier).alias("_carried"))
    return here.join(carried, [*by, SLAB]).withColumn(name, F.coalesce("_here", "_carried")).drop(_KEY, SLAB, "_here", "_carried", "_is_last")


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int, name: str = "position"
) -> DataFrame:
    """The first `count` rows of each key.

    Up to the session's limit (`spark.sql.optimizer.windowGroupLimitThreshold`) Spark
    trims every key before the shuffle, so a hot key costs no more than any other;
    beyond, keys are numbered by slabs.
    """
    if count > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        return row_numbers(df, keys, order, name).where(F.col(name) <= count)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= count)


def range_by_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], start: int, stop: int, name: str = "position"
) -> DataFrame:
    """Rows at positions `start`..`stop` (from 0, inclusive; negatives from the end)."""
    if start >= 0 and stop >= 0:
        ends = top_per_key(df, keys, order, stop + 1, name).withColumn(name, F.col(name) - 1)
        return ends.where(F.col(name) >= start)
    placed = row_numbers(df, keys, order, name, start=0, total="_size")
    first = F.lit(start) if start >= 0 else F.col("_size") + start
    last = F.lit(stop) if stop >= 0 else F.col("_size") + stop
    return placed.where(F.col(name).between(first, last)).drop("_size")
