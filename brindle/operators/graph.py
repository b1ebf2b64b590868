"""Property graphs as two tables.

nodes(id, labels, properties...) · edges(src, dst, type, properties...)
A pattern is a chain of hops: each hop is one join with the edges and, where the
far node's properties are wanted, one with the nodes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.changes import next_ids
from brindle.operators.ordering import top_per_key
from brindle.operators.skew import plain_side
from brindle.session import materialize


@dataclass(frozen=True)
class Graph:
    nodes: DataFrame
    edges: DataFrame


def has_label(label: str) -> Column:
    return F.array_contains("labels", label)


def with_label(nodes: DataFrame, label: str) -> DataFrame:
    return nodes.where(has_label(label))


def add_label(nodes: DataFrame, predicate: Column, label: str) -> DataFrame:
    grown = F.array_union("labels", F.array(F.lit(label)))
    return nodes.withColumn("labels", F.when(predicate, grown).otherwise(F.col("labels")))


def remove_label(nodes: DataFrame, label: str) -> DataFrame:
    return nodes.withColumn("labels", F.array_remove("labels", label))


def named(nodes: DataFrame, prefix: str, *properties: str) -> DataFrame:
    """Node ids and some properties under prefixed names."""
    return nodes.select(F.col("id").alias(prefix), *[F.col(p).alias(f"{prefix}_{p}") for p in properties])


def hop(
    df: DataFrame,
    edges: DataFrame,
    start: str,
    end: str,
    types: Sequence[str] | None = None,
    reverse: bool = False,
    properties: Sequence[str] = (),
) -> DataFrame:
    """Follow edges from the node in column `start` to a new column `end`."""
    near, far = ("dst", "src") if reverse else ("src", "dst")
    if types:
        edges = edges.where(F.col("type").isin(list(types)))
    step = edges.select(F.col(near).alias(start), F.col(far).alias(end), *properties)
    return df.join(step, start)


def attach(df: DataFrame, nodes: DataFrame, at: str, *properties: str) -> DataFrame:
    """Add properties of the node in column `at`, named `<at>_<property>`."""
    return df.join(named(nodes, at, *properties), at)


def neighbours_of(
    graph: Graph, people: DataFrame, edge_type: str, back_type: str, back: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """(start, film, other): who else is tied to the films of the given people.

    Edges are distinct, so the edge one came by is excluded by `other <> start`
    when both hops use the same type. Edges that are costly to make may be given for
    the second hop as `back`, a function of the films that were reached.
    """
    films = hop(people.select(F.col("id").alias("start")), graph.edges, "start", "film", [edge_type])
    if back is not None:
        films = materialize(films, "films")
    edges = graph.edges if back is None else back(films.select("film"))
    others = hop(films, edges, "film", "other", [back_type], reverse=True)
    return others.where(F.col("other") != F.col("start")) if edge_type == back_type else others


def both_types(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(src, dst) pairs tied by edges of both types."""
    pairs = edges.select("src", "dst", "type")
    return pairs.where(F.col("type") == a).drop("type").join(
        pairs.where(F.col("type") == b).drop("type"), ["src", "dst"], "left_semi"
    )


def without(edges: DataFrame, edge_type: str, forbidden: str) -> DataFrame:
    """Edges of a type whose source has no edge of the forbidden type."""
    barred = plain_side(edges.where(F.col("type") == forbidden).select("src").distinct())
    return edges.where(F.col("type") == edge_type).join(barred, "src", "left_anti")


def degrees(edges: DataFrame, edge_type: str, end: str = "src") -> DataFrame:
    return edges.where(F.col("type") == edge_type).groupBy(F.col(end).alias("id")).agg(F.count("*").alias("degree"))


def schema(graph: Graph) -> DataFrame:
    """How many edges of each type run between which label sets.

    Edges are counted per (source, type, target labels) before the second join.
    """
    labels = graph.nodes.select("id", F.array_join(F.array_sort("labels"), "+").alias("label"))
    targets = labels.select(F.col("id").alias("dst"), F.col("label").alias("dst_label"))
    sources = labels.select(F.col("id").alias("src"), F.col("label").alias("src_label"))
    half = (
        graph.edges.select("src", "type", "dst").join(targets, "dst")
        .groupBy("src", "type", "dst_label").agg(F.count("*").alias("n"))
    )
    return half.join(sources, "src").groupBy("src_label", "type", "dst_label").agg(F.sum("n").alias("n"))


def label_sets(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy(F.array_join(F.array_sort("labels"), "+").alias("labels")).agg(F.count("*").alias("n"))


def first_per_source(df: DataFrame, source: str, order: Sequence[Column], count: int) -> DataFrame:
    return top_per_key(df, [source], order, count)


def merge_nodes(nodes: DataFrame, wanted: DataFrame, match: Sequence[str]) -> DataFrame:
    """Add the wanted nodes whose whole pattern (`match`, and the labels) is not there yet.

    New nodes get the ids after the greatest one, in the order of their pattern, unless the pattern gives the id.
    """
    given = "id" in match or "id" not in nodes.columns
    pattern = (wanted if given else wanted.drop("id")).withColumn("labels", F.array_sort(F.array_distinct("labels")))
    fresh = pattern.dropDuplicates([*match, "labels"])
    have = nodes.select(*match, F.col("labels").alias("_have"))
    same = [nodes_c.eqNullSafe(wanted_c) for nodes_c, wanted_c in ((have[m], fresh[m]) for m in match)]
    covered = F.size(F.array_except(fresh["labels"], F.col("_have"))) == 0
    missing = fresh.join(have, [*same, covered], "left_anti")
    if not given:
        top = nodes.agg(F.max("id").alias("top"))
        missing = next_ids(missing, top, [*[F.col(m) for m in match], F.col("labels")], "id")
    return nodes.unionByName(missing, allowMissingColumns=True)


def merge_edges(edges: DataFrame, wanted: DataFrame) -> DataFrame:
    """Add the wanted edges whose (src, type, dst) is not there yet."""
    identity = ["src", "type", "dst"]
    missing = wanted.dropDuplicates(identity).join(edges.select(*identity), identity, "left_anti")
    return edges.unionByName(missing, allowMissingColumns=True)


def detach_delete(graph: Graph, predicate: Column) -> Graph:
    """Delete nodes together with every edge that touches them."""
    doomed = plain_side(graph.nodes.where(F.coalesce(predicate, F.lit(False))).select("id"))
    kept = graph.nodes.join(doomed, "id", "left_anti")
    edges = graph.edges
    for end in ("src", "dst"):
        edges = edges.join(doomed.select(F.col("id").alias(end)), end, "left_anti")
    return Graph(kept, edges.select(*graph.edges.columns))
