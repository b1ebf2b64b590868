import pytest
from pyspark.sql import functions as F

from brindle.operators import graph as g
from tests.conftest import rows


@pytest.fixture(scope="module")
def films(spark):
    nodes = spark.createDataFrame(
        [(1, ["Person", "Director"], "Tom Hanks", None, None), (2, ["Person"], "Liv Tyler", None, None), (3, ["Person"], "Rita Wilson", None, None),
         (4, ["Person", "Director"], "Lana Wachowski", None, None), (10, ["Movie"], None, "That Thing You Do", 1996),
         (11, ["Movie"], None, "Cloud Atlas", 2012), (12, ["Movie"], None, "Sleepless in Seattle", 1993)],
        "id long, labels array<string>, name string, title string, released int")
    edges = spark.createDataFrame(
        [(1, 10, "ACTED_IN"), (2, 10, "ACTED_IN"), (1, 10, "DIRECTED"), (1, 11, "ACTED_IN"), (4, 11, "DIRECTED"),
         (1, 12, "ACTED_IN"), (3, 12, "ACTED_IN"), (4, 1, "FOLLOWS")], "src long, dst long, type string")
    return g.Graph(nodes, edges)


def test_hops(films):
    tom = films.nodes.where("name = 'Tom Hanks'").select("id")
    co = g.attach(g.neighbours_of(films, tom, "ACTED_IN", "ACTED_IN"), films.nodes, "other", "name")
    assert rows(co, "other_name", "film") == [("Liv Tyler", 10), ("Rita Wilson", 12)]
    directors = g.neighbours_of(films, tom, "ACTED_IN", "DIRECTED")
    assert rows(directors, "film", "other") == [(10, 1), (11, 4)]
    anything = g.hop(g.named(films.nodes, "p"), films.edges, "p", "m", properties=["type"])
    assert anything.count() == 8


def test_relations(films):
    assert rows(g.both_types(films.edges, "ACTED_IN", "DIRECTED")) == [(1, 10)]
    assert rows(g.without(films.edges, "ACTED_IN", "DIRECTED"), "src", "dst") == [(2, 10), (3, 12)]
    assert rows(g.degrees(films.edges, "ACTED_IN")) == [(1, 3), (2, 1), (3, 1)]
    assert rows(g.label_sets(films.nodes)) == [("Director+Person", 2), ("Movie", 3), ("Person", 2)]
    assert ("Director+Person", "FOLLOWS", "Director+Person", 1) in rows(g.schema(films))


def test_labels(films):
    people = g.with_label(films.nodes, "Person")
    assert g.with_label(g.remove_label(people, "Director"), "Director").count() == 0
    assert g.with_label(g.add_label(people, F.col("id") == 2, "Star"), "Star").count() == 1


def test_merge_is_idempotent(spark, films):
    wanted = spark.createDataFrame(
        [(1, ["Person"], "Tom Hanks"), (7, ["Person"], "Hugo Weaving"), (7, ["Person"], "Hugo Weaving"), (2, ["Person", "Director"], "Liv Tyler")],
        "id long, labels array<string>, name string")
    once = g.merge_nodes(films.nodes, wanted, ["id", "name"])
    assert once.count() == films.nodes.count() + 2  # Hugo, and Liv as a director
    assert rows(g.merge_nodes(once, wanted, ["id", "name"])) == rows(once)
    new = spark.createDataFrame([(1, 10, "ACTED_IN"), (2, 11, "ACTED_IN")], films.edges.schema)
    merged = g.merge_edges(films.edges, new)
    assert merged.count() == 9 and g.merge_edges(merged, new).count() == 9


def test_detach_delete(films):
    left = g.detach_delete(films, F.col("name") == "Tom Hanks")
    assert left.nodes.count() == 6
    assert rows(left.edges, "src", "dst") == [(2, 10), (3, 12), (4, 11)]
