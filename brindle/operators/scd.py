"""Slowly changing dimensions.

`state` holds versions with `validfrom` and `validto`; `changes` holds the
tracked columns with an `effective` date, any number of rows per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.dates import OPEN_END
from brindle.operators.changes import next_ids, update_by_key
from brindle.operators.ordering import last_known
from brindle.session import materialize


def _last_per_day(changes: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """At most one change per key and day, so a key has no more rows than days.

    Among several of one day the greatest value wins, for want of a finer time.
    """
    return (
        changes.groupBy(key, "effective")
        .agg(F.max(F.struct(*tracked)).alias("_new"))
        .select(key, "effective", *[F.col(f"_new.{c}").alias(c) for c in tracked])
    )


def apply_type1(state: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Overwrite the tracked columns with their newest values; no history."""
    days = _last_per_day(changes, key, tracked)
    newest = days.groupBy(key).agg(F.max_by(F.struct(*tracked), "effective").alias("_new"))
    newest = newest.select(key, *[F.col(f"_new.{c}").alias(c) for c in tracked])
    return update_by_key(state, newest, key, tracked)


def apply_type2(
    state: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], surrogate: str, top: DataFrame | None = None
) -> DataFrame:
    """Close the open version of every changed key and add new versions.

    A version ends the day before the next one starts. Changes that repeat the
    value in force, or are not newer than the open version, have no effect; for a
    key without an open version the same holds of its last closed one.
    Unknown keys are inserted. New versions get surrogate keys after the
    greatest one in use, in order of date and key. If `state` is only the part of a
    table that the changes concern, `top` says which that is.
    """
    open_end = F.lit(OPEN_END).cast("date")
    closed = state.where(F.col("validto") != open_end)
    current = state.where(F.col("validto") == open_end)
    fields = F.struct(*tracked)
    steps = current.select(key, surrogate, fields.alias("_v"), F.col("validfrom").alias("_at")).unionByName(
        _last_per_day(changes, key, tracked).select(key, fields.alias("_v"), F.col("effective").alias("_at")),
        allowMissingColumns=True,
    )
    ends = closed.groupBy(key).agg(F.max("validto").alias("_closed"))
    steps = steps.join(ends, key, "left")
    whole = Window.partitionBy(key)
    line = Window.partitionBy(key).orderBy("_at", F.col(surrogate).asc_nulls_last())
    versions = (
        steps.withColumn("_open_from", F.max(F.when(F.col(surrogate).isNotNull(), F.col("_at"))).over(whole))
        .where(F.col(surrogate).isNotNull() | (F.col("_at") > F.coalesce("_open_from", "_closed", F.lit("0001-01-01").cast("date"))))
        .withColumn("_before", F.lag("_v").over(line))
        .where(F.col("_before").isNull() | ~F.col("_v").eqNullSafe(F.col("_before")))
        .withColumn("validto", F.coalesce(F.date_sub(F.lead("_at").over(line), 1), open_end))
        .select(surrogate, key, *[F.col(f"_v.{c}").alias(c) for c in tracked], F.col("_at").alias("validfrom"), "validto")
    )
    versions = materialize(versions, "versions")
    kept = versions.where(F.col(surrogate).isNotNull())
    added = next_ids(
        versions.where(F.col(surrogate).isNull()).drop(surrogate),
        state.agg(F.max(surrogate).alias("top")) if top is None else top, [F.col("validfrom"), F.col(key)], surrogate,
    )
    rest = [c for c in state.columns if c not in kept.columns]
    if rest:  # attributes outside the tracked set follow the key
        carried = current.select(key, *rest)
        kept, added = kept.join(carried, key, "left"), added.join(carried, key, "left")
    return closed.unionByName(kept).unionByName(added)


def at_time(facts: DataFrame, versions: DataFrame, key: str, day: str) -> DataFrame:
    """Join each fact to the version in force on its day."""
    valid = (facts[key] == versions[key]) & facts[day].between(versions["validfrom"], versions["validto"])
    return facts.join(versions, valid).drop(versions[key])


def as_of(facts: DataFrame, versions: DataFrame, key: str, at: str, since: str = "validfrom", until: str | None = "validto") -> DataFrame:
    """Join each fact to the version in force at its time, by carrying versions along one ordering of both.

    No fact is compared with more than one version, so a key with very many versions and facts costs what its rows do,
    and is spread over many tasks. Versions of a key start at different times; of those that start together one counts.
    Without `until` a version holds to the next one. Facts before the first version are left out, and NULL keys.
    """
    both = (
        versions.select(key, F.col(since).alias("_at"), F.lit(0).alias("_late"), F.struct(*[F.col(c) for c in versions.columns if c != key]).alias("_version"))
        .unionByName(
            facts.select(key, F.col(at).alias("_at"), F.lit(1).alias("_late"), F.struct(*[F.col(c) for c in facts.columns if c != key]).alias("_fact")),
            allowMissingColumns=True,
        )
        .where(F.col(key).isNotNull() & F.col("_at").isNotNull())
    )
    seen = last_known(both, [key], [F.col("_at"), F.col("_late")], "_version", "_now")
    holds = F.col("_now").isNotNull() if until is None else F.col("_now").isNotNull() & (F.col(f"_now.{until}").isNull() | (F.col("_at") <= F.col(f"_now.{until}")))
    return seen.where(F.col("_fact").isNotNull() & holds).select(key, "_fact.*", "_now.*")
