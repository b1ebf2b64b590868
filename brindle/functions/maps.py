"""Hash-record expressions over map columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def set_fields(record: Column, **values: Column) -> Column:
    """Set fields; an existing field is overwritten."""
    pairs = [c for name, value in values.items() for c in (F.lit(name), value.cast("string"))]
    kept = F.map_filter(record, lambda k, _: ~k.isin(list(values)))
    return F.map_concat(kept, F.create_map(*pairs))


def delete_fields(record: Column, *names: str) -> Column:
    return F.map_filter(record, lambda k, _: ~k.isin(list(names)))


def as_text(record: Column) -> Column:
    """`field=value` pairs in field order."""
    pairs = F.transform(F.map_entries(record), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.array_join(F.array_sort(pairs), ",")
