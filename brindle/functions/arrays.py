"""List expressions over array columns, with the index rules of a key-value list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brindle.functions.hashing import stable_hash


def push_left(items: Column, value: Column) -> Column:
    return F.array_prepend(items, value)


def push_right(items: Column, value: Column) -> Column:
    return F.array_append(items, value)


def insert_before(items: Column, pivot: Column, value: Column) -> Column:
    """Put `value` before the first `pivot`; a list without it stays as it is."""
    at = F.array_position(items, pivot).cast("int")
    # The position must not be 0, even in the branch that is not taken.
    return F.when(at > 0, F.array_insert(items, F.greatest(at, F.lit(1)), value)).otherwise(items)


def _from_start(index: int, size: Column) -> Column:
    return F.lit(index) if index >= 0 else F.greatest(size + F.lit(index), F.lit(0))


def slice_range(items: Column, start: int, stop: int) -> Column:
    """Elements `start`..`stop`, both inclusive and from 0; negatives count from the end."""
    size = F.size(items)
    first = _from_start(start, size)
    last = F.lit(stop) if stop >= 0 else size + F.lit(stop)
    return F.slice(items, first + 1, F.greatest(last - first + 1, F.lit(0)))


def at(items: Column, index: int) -> Column:
    return F.get(items, F.lit(index) if index >= 0 else F.size(items) + F.lit(index))


def pop_left(items: Column) -> Column:
    """Struct of the value taken from the left and the list that remains."""
    rest = F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0)))
    return F.struct(F.get(items, F.lit(0)).alias("value"), rest.alias("rest"))


def pop_right(items: Column) -> Column:
    size = F.size(items)
    rest = F.slice(items, F.lit(1), F.greatest(size - 1, F.lit(0)))
    return F.struct(F.get(items, size - 1).alias("value"), rest.alias("rest"))


def field_of_each(objects: Column, field: str) -> Column:
    """One field of every object in an array."""
    return F.transform(objects, lambda o: o[field])


def choose(items: Column, count: Column, *seed: Column) -> Column:
    """`count` elements without replacement, fixed by the seed; all of them if there are fewer.

    Each step takes one element of those that remain, so there is one hash per
    pick and not one per element.
    """

    def pick(state, step):
        rest = state["rest"]
        at = F.pmod(stable_hash(*seed, step), F.greatest(F.size(rest), F.lit(1))).cast("int")
        left = F.concat(F.slice(rest, F.lit(1), at), F.slice(rest, at + 2, F.size(rest)))
        return F.struct(left.alias("rest"), F.array_append(state["picked"], F.get(rest, at)).alias("picked"))

    picks = F.least(count, F.size(items))
    steps = F.when(picks > 0, F.sequence(F.lit(0), picks - 1)).otherwise(F.array().cast("array<int>"))
    start = F.struct(items.alias("rest"), F.slice(items, 1, 0).alias("picked"))
    return F.aggregate(steps, start, pick, lambda state: state["picked"])


def choose_up_to(items: Column, most: int, *seed: Column) -> Column:
    """Between one and `most` elements; an empty list gives an empty list."""
    size = F.size(items)
    top = F.least(F.lit(most), size)
    count = F.when(top > 0, F.pmod(stable_hash(*seed), F.greatest(top, F.lit(1))).cast("int") + 1).otherwise(0)
    return choose(items, count, *seed)
