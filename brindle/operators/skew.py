"""Joins whose larger side may have most of its rows under one key.

Spark splits such a key at runtime (`spark.sql.adaptive.skewJoin`), but only where
both sides of the join come straight out of a shuffle. Where one side is an
aggregate or another join, it is written first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from brindle.session import materialize


def plain_side(df: DataFrame) -> DataFrame:
    """The smaller side of a join as a written table.

    Spark then knows its size before it chooses the join, and can split hot keys
    of the other side.
    """
    return materialize(df, "side")
