"""Nesting rows into documents and back.

A group may be larger than any one document should be. Nested members are
therefore kept in pages: full ones but for the last, which one after the other are
the group's ordered list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.ordering import row_numbers

PAGE_ROWS = 1000


def collect_pages(
    df: DataFrame, keys: Sequence[str], member: Column, name: str, page_rows: int = PAGE_ROWS, order: Sequence[str] = ()
) -> DataFrame:
    """Members per key as arrays, with `page` (from 0) and the `total` of the key.

    Without `order` the members are an ordered set: repeats fold into one, and NULL
    is no member. With it every row is kept, in the order of those columns.
    """
    columns = [c for c in order if c not in keys]
    members = df.select(*keys, member.alias("_member"), *columns)
    if not order:
        members = members.where(F.col("_member").isNotNull()).distinct()
    by = [F.col(c) for c in columns] or [F.col("_member")]
    placed = row_numbers(members, keys, by, "_place", start=0, total="total")
    page = F.floor(F.col("_place") / page_rows).alias("page")
    paged = placed.groupBy(*keys, "total", page).agg(F.sort_array(F.collect_list(F.struct("_place", "_member"))).alias("_members"))
    return paged.withColumn(name, F.transform("_members", lambda m: m["_member"])).drop("_members")


def pages_sql(members: str, keys: str, name: str, page_rows: int = PAGE_ROWS, mark: str = ", ") -> str:
    """The same in SQL for text members; `members` selects `keys` and `v`."""
    return f"""
    WITH m AS (SELECT DISTINCT * FROM ({members}) WHERE v IS NOT NULL),
    p AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY v) - 1 AS place, count(*) OVER (PARTITION BY {keys}) AS total FROM m)
    SELECT {keys}, total, place // {page_rows} AS page, string_agg(v, '{mark}' ORDER BY place) AS {name}
    FROM p GROUP BY {keys}, total, page"""


def embed(
    parents: DataFrame,
    children: DataFrame,
    key: str,
    fields: Sequence[str],
    name: str,
    identity: Sequence[str],
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Parents with their children nested as an array of structs, in pages.

    `identity` tells the children of one parent apart and orders them. A parent
    without children keeps one row with an empty array.
    """
    nested = collect_pages(children, [key], F.struct(*fields), name, page_rows, identity)
    return (
        parents.join(nested, key, "left")
        .withColumn("total", F.coalesce("total", F.lit(0)))
        .withColumn("page", F.coalesce("page", F.lit(0)))
        .withColumn(name, F.coalesce(name, F.array().cast(nested.schema[name].dataType)))
    )


def unwind(df: DataFrame, column: str) -> DataFrame:
    """One row per element; rows with an empty or missing array disappear."""
    return df.withColumn(column, F.explode(column))


def lookup(
    left: DataFrame,
    right: DataFrame,
    local: str,
    foreign: str,
    name: str,
    identity: Sequence[str],
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Matches of each left row as a nested array, in pages; no match gives an empty array."""
    match = F.struct(*right.columns)
    keyed = right.select(F.col(foreign).alias(local), match.alias("_match"),
                         *[F.col(c).alias(f"_id_{c}") for c in identity])
    nested = embed(left, keyed, local, ["_match"], name, [f"_id_{c}" for c in identity], page_rows)
    return nested.withColumn(name, F.transform(name, lambda s: s["_match"]))


def lookup_unwind(left: DataFrame, right: DataFrame, local: str, foreign: str, name: str) -> DataFrame:
    """Lookup followed by unwind: a join that nests the right row. Nothing is collected."""
    nested = right.select(F.col(foreign).alias("_foreign"), F.struct(*right.columns).alias(name))
    return left.join(nested, F.col(local) == F.col("_foreign")).drop("_foreign")
