"""Hashes that are the same in every engine, for repeatable random choices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_hash(*parts: Column) -> Column:
    """32 bits of the MD5 digest of the parts joined by `|`, as a long."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def stable_hash_sql(*parts: str) -> str:
    """The same hash as SQL text."""
    text = "concat_ws('|', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def pick(count: Column | int, *parts: Column) -> Column:
    """A repeatable index in 0..count-1."""
    count = F.lit(count) if isinstance(count, int) else count
    return F.pmod(stable_hash(*parts), count).cast("int")
