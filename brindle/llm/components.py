"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has an edge; `root` is the least node of its component.

    Nodes are bigints. Each step writes its edges, of which there are never more than twice as many as at first, and
    the number of steps grows with the logarithm of the longest chain.
    """
    found = materialize(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    before = _state(found)
    while before[0]:
        both = found.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            found.select(F.col("v").alias("x"), F.col("u").alias("y"))
        )
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        least = materialize(least, "least")
        large = materialize(
            both.where(F.col("y") > F.col("x")).join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct(),
            "large",
        )
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        down = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        found = materialize(down.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _state(found)
        if after == before:
            break
        before = after
    roots = found.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(found.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
