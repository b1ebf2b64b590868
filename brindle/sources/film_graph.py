"""A film graph read from the order tables.

A customer is a person, a part is a film, a purchase is a role and a review, and
the supplier of a part directs it as the person with the same number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.operators.graph import Graph
from brindle.operators.ordering import row_numbers
from brindle.sources.tables import Tables

FILM_BASE = 1_000_000_000_000
GENRE_BASE = 2_000_000_000_000
COUNTRY_BASE = 3_000_000_000_000


def people(t: Tables) -> DataFrame:
    """People as plain nodes, without the labels that take a join to find."""
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.array(F.lit("Person")).alias("labels"), F.col("c_name").alias("name"))


def labelled_people(t: Tables) -> DataFrame:
    directors = t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("Director").alias("_director"))
    labels = F.array_compact(F.array(F.lit("Person"), F.col("_director")))
    return people(t).drop("labels").join(directors, "id", "left").select("id", labels.alias("labels"), "name")


def films(t: Tables) -> DataFrame:
    return t.part.select(
        (F.col("p_partkey") + FILM_BASE).alias("id"), F.array(F.lit("Film")).alias("labels"),
        F.col("p_name").alias("title"), (F.col("p_size") + 1990).alias("released"),
    )


def genres(t: Tables) -> DataFrame:
    names = t.part.select(F.col("p_type").alias("name")).distinct()
    keyed = row_numbers(names, [], [F.col("name")], "id")
    return keyed.select((F.col("id") + GENRE_BASE).alias("id"), F.array(F.lit("Genre")).alias("labels"), "name")


def reviews(t: Tables, people: DataFrame | None = None, films: DataFrame | None = None) -> DataFrame:
    """REVIEWED edges with a rating and a summary, one per bought line.

    Given `people` (id) or `films` (film), only theirs: the others leave before the join.
    """
    buyers, lines = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("src")), t.lineitem
    if people is not None:
        buyers = buyers.join(people.select(F.col("id").alias("src")), "src", "left_semi")
    if films is not None:
        lines = lines.join(films.select((F.col("film") - FILM_BASE).alias("l_partkey")).distinct(), "l_partkey", "left_semi")
    return lines.join(buyers, "l_orderkey").select(
        "src", (F.col("l_partkey") + FILM_BASE).alias("dst"), F.lit("REVIEWED").alias("type"),
        F.col("l_quantity").cast("int").alias("rating"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("summary"),
    )


def acted(t: Tables, people: DataFrame | None = None, films: DataFrame | None = None) -> DataFrame:
    return reviews(t, people, films).select("src", "dst").distinct().withColumn("type", F.lit("ACTED_IN"))


def directed(t: Tables, films: DataFrame | None = None) -> DataFrame:
    lines = t.lineitem
    if films is not None:
        lines = lines.join(films.select((F.col("film") - FILM_BASE).alias("l_partkey")).distinct(), "l_partkey", "left_semi")
    return lines.select(
        F.col("l_suppkey").alias("src"), (F.col("l_partkey") + FILM_BASE).alias("dst")
    ).distinct().withColumn("type", F.lit("DIRECTED"))


def graph_of(t: Tables, people: DataFrame) -> Graph:
    """The same nodes, and who of some `people` acted in which film."""
    return Graph(film_graph(t).nodes, acted(t, people))


def film_graph(t: Tables, all_labels: bool = False) -> Graph:
    """People, films, and who acted in or directed which film."""
    persons = labelled_people(t) if all_labels else people(t)
    nodes = persons.unionByName(films(t), allowMissingColumns=True)
    return Graph(nodes, acted(t).unionByName(directed(t)))
