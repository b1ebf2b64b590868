"""Mutations as functions: `apply(state, changes) -> new state`.

`changes` is a DataFrame with at most one row per key unless a function says
otherwise. To keep a result, write it as a new version (see `brindle.sinks`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.ordering import row_numbers


def _marked(changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Changes as one struct column, so that a NULL value can be told from no change."""
    return changes.select(key, F.struct(*columns).alias("_new"))


def update_by_key(state: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Set `columns` of the rows whose key is in `changes`; other keys change nothing."""
    joined = state.join(_marked(changes, key, columns), key, "left")
    changed = F.col("_new").isNotNull()
    picks = {c: F.when(changed, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(picks).select(*state.columns)


def returning(state: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The changed rows, each with its new values and the old ones as `old_*`."""
    return (
        state.join(_marked(changes, key, columns), key)
        .withColumns({f"old_{c}": F.col(c) for c in columns} | {c: F.col(f"_new.{c}") for c in columns})
        .drop("_new")
    )


def unused_only(changes: DataFrame, state: DataFrame, key: str, column: str) -> DataFrame:
    """Changes whose new value nobody holds; of several claims the lowest key wins."""
    first = changes.groupBy(column).agg(F.min(key).alias(key))
    return first.join(state.select(column).distinct(), column, "left_anti").select(key, column)


def matching_old(changes: DataFrame, state: DataFrame, key: str, column: str, expected: str) -> DataFrame:
    """Changes whose expected old value is still the current one."""
    current = state.select(key, F.col(column).alias(expected))
    return changes.join(current, [key, expected], "left_semi")


def upsert(state: DataFrame, changes: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Replace rows whose key is in `changes` and insert the others. Idempotent."""
    keys = [key] if isinstance(key, str) else list(key)
    columns = [c for c in state.columns if c not in keys]
    old = state.select(*keys, F.struct(*columns).alias("_old"))
    new = changes.select(*keys, F.struct(*columns).alias("_new"))
    row = F.coalesce("_new", "_old")
    return old.join(new, keys, "full").select(*keys, *[row[c].alias(c) for c in columns]).select(*state.columns)


def next_ids(rows: DataFrame, top: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number `rows` onwards from the one-row DataFrame `top` with column `top`."""
    placed = row_numbers(rows, [], order, name)
    start = F.coalesce(top.select("top").scalar(), F.lit(0))
    return placed.withColumn(name, F.col(name) + start)


def get_or_create(names: DataFrame, state: DataFrame, name: str, id_name: str) -> DataFrame:
    """`state` with a row for every name; new names get the next ids in name order."""
    missing = names.select(name).distinct().join(state, name, "left_anti")
    top = state.agg(F.max(id_name).alias("top"))
    return state.unionByName(next_ids(missing, top, [F.col(name)], id_name))


def set_where(df: DataFrame, predicate: Column, **values: Column) -> DataFrame:
    """Set columns on every matching row; a NULL predicate does not match."""
    hit = F.coalesce(predicate, F.lit(False))
    types = {f.name: f.dataType for f in df.schema.fields}

    def pick(name, value):
        old = F.col(name) if name in types else F.lit(None)
        return F.when(hit, value.cast(types[name]) if name in types else value).otherwise(old)

    return df.withColumns({name: pick(name, value) for name, value in values.items()})


def set_first(df: DataFrame, predicate: Column, identity: str, **values: Column) -> DataFrame:
    """Like `set_where`, on the matching row with the lowest id only."""
    lowest = df.where(predicate).agg(F.min(identity).alias("lowest")).scalar()
    return set_where(df, predicate & (F.col(identity) == lowest), **values)


def unset_where(df: DataFrame, predicate: Column, *columns: str) -> DataFrame:
    """Remove fields from the matching rows; a removed field is NULL."""
    return set_where(df, predicate, **{c: F.lit(None) for c in columns})


def increment(df: DataFrame, predicate: Column, **steps: Column) -> DataFrame:
    """Add to numeric fields; a missing field counts as 0."""
    return set_where(df, predicate, **{c: F.coalesce(F.col(c), F.lit(0)) + step for c, step in steps.items()})


def multiply(df: DataFrame, predicate: Column, **factors: Column) -> DataFrame:
    """Multiply numeric fields; a missing field becomes 0."""
    return set_where(df, predicate, **{c: F.coalesce(F.col(c), F.lit(0)) * k for c, k in factors.items()})


def set_nested(df: DataFrame, predicate: Column, column: str, **fields: Column) -> DataFrame:
    """Set fields of a sub-document where it exists."""
    new = F.col(column)
    for name, value in fields.items():
        new = new.withField(name, value)
    return set_where(df, predicate & F.col(column).isNotNull(), **{column: new})


def upsert_matching(df: DataFrame, filters: DataFrame, on: str, **values: Column) -> DataFrame:
    """Set `values` on rows whose `on` is in `filters`; a filter without a row inserts one."""
    asked = filters.select(on).distinct().withColumn("_asked", F.lit(True))
    joined = df.withColumn("_there", F.lit(True)).join(asked, on, "full")
    out = set_where(joined, F.col("_asked"), **values)
    return out.drop("_asked", "_there")


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that do not match; a missing field never matches, so such rows stay."""
    return df.where(~F.coalesce(predicate, F.lit(False)))
