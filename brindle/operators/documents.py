"""Predicates and grouping with document rules: a field may be missing.

A comparison never matches a missing field, and a negation does match it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _met(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def any_of(*predicates: Column) -> Column:
    return reduce(lambda a, b: a | b, map(_met, predicates))


def all_of(*predicates: Column) -> Column:
    return reduce(lambda a, b: a & b, map(_met, predicates))


def not_(predicate: Column) -> Column:
    return ~_met(predicate)


def none_of(*predicates: Column) -> Column:
    return ~any_of(*predicates)


def exists(field: Column) -> Column:
    return field.isNotNull()


def find(df: DataFrame, predicate: Column | None = None, *fields: str) -> DataFrame:
    """Matching documents, all fields or the named ones."""
    found = df if predicate is None else df.where(predicate)  # as it is, so that the scan can use it
    return found.select(*fields) if fields else found


def find_one(df: DataFrame, identity: str, predicate: Column | None = None) -> DataFrame:
    """The matching document with the lowest id."""
    return find(df, predicate).orderBy(identity).limit(1)


def insert(collection: DataFrame, documents: DataFrame) -> DataFrame:
    """Add documents; a field that one side lacks is NULL there."""
    return collection.unionByName(documents, allowMissingColumns=True)


def exact_mean(column: str, scale: int = 2) -> Column:
    """Average whose sum does not depend on the order of the rows."""
    total = F.sum(F.col(column).cast(f"decimal(18,{scale})"))
    return total.cast("double") / F.count(column)
