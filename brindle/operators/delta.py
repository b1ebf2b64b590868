"""Refresh by difference: what changed between two states of the source tables, carried through joins to kept sums.

Keys whose rows changed are found by comparing checksums of each key, so only narrow sums are shuffled. A change of a
looked-up table reaches the rows that refer to it; these, and the rows that changed themselves, are built twice, from the
old tables with the sign -1 and from the new ones with +1. What is equal in both cancels out when it is added up. Kept
sums take the signed rows in; a group whose rows are all gone leaves with them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.operators.skew import plain_side

Source = Mapping[str, DataFrame]


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys whose rows are not the same in both, however often rows repeat; NULL is left out.

    A key's checksum adds up hashes of its whole rows, so hot keys are summed before the shuffle.
    """
    columns = sorted(old.columns)
    if columns != sorted(new.columns):
        raise ValueError(f"the old rows have {columns}, the new ones {sorted(new.columns)}")

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        print_ = F.xxhash64(*columns).cast("decimal(20,0)") * sign
        return rows.select(key, print_.alias("_print"), F.lit(sign).alias("_sign"))

    sums = signed(old, -1).unionByName(signed(new, 1)).groupBy(key).agg(F.sum("_print").alias("_print"), F.sum("_sign").alias("_sign"))
    return sums.where(F.col(key).isNotNull() & ((F.col("_print") != 0) | (F.col("_sign") != 0))).select(key)


def _affected(rows: DataFrame, keys: Mapping[str, DataFrame]) -> DataFrame:
    """Rows with one of the keys in one of the columns, each once."""
    parts, rest = [], rows
    for column, changed in keys.items():
        parts.append(rest.join(changed, column, "left_semi"))
        rest = rest.join(changed, column, "left_anti")
    return reduce(DataFrame.unionByName, parts)


def signed_changes(
    build: Callable[[Source], DataFrame], old: Source, new: Source, rows: str, own: str, lookups: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """What `build` makes of the old and the new tables, as far as it differs: old rows with `sign` -1, new ones with 1.

    `rows` names the table that `build` makes its rows from; `own` is a column of it by which changed rows are found.
    `lookups` gives for each table that is looked up its key and the column of `rows` that refers to it. Rows of one
    value of `own` that did not change may come with both signs.
    """
    found: dict[str, list[DataFrame]] = {own: [changed_keys(old[rows], new[rows], own)]}
    for name, (key, column) in lookups.items():
        found.setdefault(column, []).append(changed_keys(old[name], new[name], key).withColumnRenamed(key, column))
    keys = {column: plain_side(reduce(DataFrame.unionByName, parts).distinct()) for column, parts in found.items()}
    made = [
        build({**state, rows: _affected(state[rows], keys)}).withColumn("sign", F.lit(sign))
        for state, sign in ((old, -1), (new, 1))
    ]
    return made[0].unionByName(made[1])


def tallied(rows: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Kept sums: for each group its number of rows, `rows`, and the sums; `sign` counts where there is one."""
    sign = F.col("sign") if "sign" in rows.columns else F.lit(1)
    return rows.groupBy(*by).agg(F.sum(sign).alias("rows"), *[F.sum(F.col(c) * sign).cast("decimal(28,2)").alias(c) for c in sums])


def refreshed(kept: DataFrame, changes: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """The kept sums after the signed changes; NULL is a group like any other."""
    more = tallied(changes, by, sums)
    both = kept.select(*by, "rows", *sums).unionByName(more.select(*by, "rows", *sums))
    added = both.groupBy(*by).agg(F.sum("rows").alias("rows"), *[F.sum(c).cast("decimal(28,2)").alias(c) for c in sums])
    return added.where(F.col("rows") != 0)
