"""Pattern queries on the film graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.operators import graph as g
from brindle.operators.nesting import collect_pages, pages_sql
from brindle.registry import query
from brindle.sinks import replace_all
from brindle.sources import film_graph as src
from brindle.sources.tables import Tables

ACTED_SQL = "(SELECT DISTINCT o_custkey AS src, l_partkey AS dst FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"
DIRECTED_SQL = "(SELECT DISTINCT l_suppkey AS src, l_partkey AS dst FROM lineitem)"
ACTOR = "Customer#000000003"


def _actor(graph: g.Graph) -> DataFrame:
    return g.with_label(graph.nodes, "Person").where(F.col("name") == ACTOR).select("id")


@query("graph_label_scan", """
SELECT c_custkey AS id, c_name AS name, 'Person+Director' AS labels FROM customer WHERE c_custkey IN (SELECT s_suppkey FROM supplier)""")
def graph_label_scan(t: Tables) -> DataFrame:
    """Nodes with one label, and all their labels."""
    return g.with_label(src.film_graph(t, all_labels=True).nodes, "Director").select("id", "name", F.array_join("labels", "+").alias("labels"))


@query("graph_bulk_load", f"""
SELECT 'nodes' AS name, (SELECT count(*) FROM customer) + (SELECT count(*) FROM part) AS rows
UNION ALL SELECT 'edges', (SELECT count(*) FROM {ACTED_SQL}) + (SELECT count(*) FROM {DIRECTED_SQL})""")
def graph_bulk_load(t: Tables) -> DataFrame:
    """Nodes and edges written as one version and read back."""
    graph = src.film_graph(t, all_labels=True)
    loaded = replace_all(t.spark, {"nodes": graph.nodes, "edges": graph.edges})
    counts = [df.agg(F.lit(name).alias("name"), F.count("*").alias("rows")) for name, df in loaded.items()]
    return counts[0].unionByName(counts[1])


@query("graph_distinct_labels", """
SELECT CASE WHEN s_suppkey IS NULL THEN 'Person' ELSE 'Director+Person' END AS labels, count(*) AS n
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey GROUP BY 1
UNION ALL SELECT 'Film', count(*) FROM part""")
def graph_distinct_labels(t: Tables) -> DataFrame:
    return g.label_sets(src.film_graph(t, all_labels=True).nodes)


@query("graph_remove_label", """
SELECT 'Person' AS labels, count(*) AS n FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT 'Person+Regular', count(*) FROM customer WHERE c_mktsegment = 'BUILDING'""")
def graph_remove_label(t: Tables) -> DataFrame:
    """Take the Director label away and mark some people with another one."""
    regulars = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("id"), F.lit(True).alias("regular"))
    people = src.labelled_people(t).join(regulars, "id", "left")
    people = g.add_label(g.remove_label(people, "Director"), F.col("regular"), "Regular")
    return g.label_sets(people)


@query("graph_schema", f"""
SELECT CASE WHEN s_suppkey IS NULL THEN 'Person' ELSE 'Director+Person' END AS src_label, type, 'Film' AS dst_label, count(*) AS n
FROM (SELECT src, 'ACTED_IN' AS type FROM {ACTED_SQL} UNION ALL SELECT src, 'DIRECTED' FROM {DIRECTED_SQL})
JOIN customer ON c_custkey = src LEFT JOIN supplier ON s_suppkey = c_custkey GROUP BY 1, 2""")
def graph_schema(t: Tables) -> DataFrame:
    return g.schema(src.film_graph(t, all_labels=True))


@query("graph_one_hop", f"""
SELECT c_name AS person_name, p_name AS film_title, type FROM
(SELECT *, 'ACTED_IN' AS type FROM {ACTED_SQL} UNION ALL SELECT *, 'DIRECTED' FROM {DIRECTED_SQL})
JOIN customer ON c_custkey = src JOIN part ON p_partkey = dst""")
def graph_one_hop(t: Tables) -> DataFrame:
    """People and films, whatever ties them."""
    graph = src.film_graph(t)
    start = g.named(g.with_label(graph.nodes, "Person"), "person", "name")
    reached = g.hop(start, graph.edges, "person", "film", properties=["type"])
    return g.attach(reached, g.with_label(graph.nodes, "Film"), "film", "title").select("person_name", "film_title", "type")


@query("graph_edge_types_to_node", f"""
SELECT c_name AS person, p_partkey + 1000000000000 AS film, type FROM
(SELECT *, 'ACTED_IN' AS type FROM {ACTED_SQL} UNION ALL SELECT *, 'DIRECTED' FROM {DIRECTED_SQL})
JOIN customer ON c_custkey = src JOIN part ON p_partkey = dst WHERE p_size + 1990 = 2005""")
def graph_edge_types_to_node(t: Tables) -> DataFrame:
    """How people are tied to the films of one year."""
    graph = src.film_graph(t)
    chosen = graph.nodes.where(F.col("released") == 2005).select(F.col("id").alias("film"))
    tied = g.hop(chosen, graph.edges, "film", "person", reverse=True, properties=["type"])
    return g.attach(tied, graph.nodes, "person", "name").select(F.col("person_name").alias("person"), "film", "type")


@query("graph_co_actors", f"""
SELECT o.c_name AS co_actor, p_name AS title, p_partkey + 1000000000000 AS film
FROM {ACTED_SQL} a JOIN customer me ON me.c_custkey = a.src AND me.c_name = '{ACTOR}'
JOIN {ACTED_SQL} b ON b.dst = a.dst AND b.src <> a.src JOIN customer o ON o.c_custkey = b.src JOIN part ON p_partkey = a.dst""")
def graph_co_actors(t: Tables) -> DataFrame:
    """Who acted with one actor, and in which films."""
    graph = src.film_graph(t)
    me = _actor(graph).select("id")
    found = g.neighbours_of(src.graph_of(t, me), me, "ACTED_IN", "ACTED_IN", back=lambda films: src.acted(t, films=films))
    found = g.attach(g.attach(found, src.people(t), "other", "name"), src.films(t), "film", "title")
    return found.select(F.col("other_name").alias("co_actor"), F.col("film_title").alias("title"), "film")


@query("graph_two_hop_directors", f"""
SELECT d.c_name AS director, p_name AS title, p_partkey + 1000000000000 AS film
FROM {ACTED_SQL} a JOIN customer me ON me.c_custkey = a.src AND me.c_name = '{ACTOR}'
JOIN {DIRECTED_SQL} b ON b.dst = a.dst JOIN customer d ON d.c_custkey = b.src JOIN part ON p_partkey = a.dst""")
def graph_two_hop_directors(t: Tables) -> DataFrame:
    """Who directed the films of one actor."""
    graph = src.film_graph(t)
    me = _actor(graph).select("id")
    found = g.neighbours_of(src.graph_of(t, me), me, "ACTED_IN", "DIRECTED", back=lambda films: src.directed(t, films))
    found = g.attach(g.attach(found, src.people(t), "other", "name"), src.films(t), "film", "title")
    return found.select(F.col("other_name").alias("director"), F.col("film_title").alias("title"), "film")


@query("graph_both_relations", f"""
SELECT c_name AS name, p_name AS title, p_partkey + 1000000000000 AS film
FROM {ACTED_SQL} a JOIN {DIRECTED_SQL} d USING (src, dst) JOIN customer ON c_custkey = src JOIN part ON p_partkey = dst""")
def graph_both_relations(t: Tables) -> DataFrame:
    """Films people both acted in and directed."""
    graph = src.film_graph(t)
    pairs = g.both_types(graph.edges, "ACTED_IN", "DIRECTED").select(F.col("src").alias("person"), F.col("dst").alias("film"))
    found = g.attach(g.attach(pairs, graph.nodes, "person", "name"), graph.nodes, "film", "title")
    return found.select(F.col("person_name").alias("name"), F.col("film_title").alias("title"), "film")


@query("graph_never_directed", f"""
SELECT c_name AS name, p_name AS title FROM {ACTED_SQL} a JOIN customer ON c_custkey = a.src JOIN part ON p_partkey = dst
WHERE a.src NOT IN (SELECT l_suppkey FROM lineitem)""")
def graph_never_directed(t: Tables) -> DataFrame:
    """Actors and films, without people who ever directed."""
    graph = src.film_graph(t)
    edges = g.without(graph.edges, "ACTED_IN", "DIRECTED").select(F.col("src").alias("person"), F.col("dst").alias("film"))
    found = g.attach(g.attach(edges, graph.nodes, "person", "name"), graph.nodes, "film", "title")
    return found.select(F.col("person_name").alias("name"), F.col("film_title").alias("title"))


def _played(t: Tables) -> DataFrame:
    """(actor, film) of the one actor."""
    me = _actor(src.film_graph(t)).select("id")
    return g.hop(me.withColumnRenamed("id", "actor"), src.acted(t, me), "actor", "film", ["ACTED_IN"])


@query("graph_skip_limit", f"""
SELECT p_name AS title, p_partkey + 1000000000000 AS film FROM {ACTED_SQL} a JOIN customer ON c_custkey = src AND c_name = '{ACTOR}'
JOIN part ON p_partkey = dst ORDER BY 1, 2 LIMIT 3 OFFSET 2""")
def graph_skip_limit(t: Tables) -> DataFrame:
    """Films of one actor by title: skip two, take three."""
    films = g.attach(_played(t), src.films(t), "film", "title").select(F.col("film_title").alias("title"), "film")
    return films.orderBy("title", "film").offset(2).limit(3)


@query("graph_top_actors", f"""
SELECT c_name AS name, count(*) AS films FROM {ACTED_SQL} a JOIN customer ON c_custkey = src GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def graph_top_actors(t: Tables) -> DataFrame:
    """Ten people with the most roles."""
    graph = src.film_graph(t)
    counted = g.degrees(graph.edges, "ACTED_IN").join(graph.nodes.select("id", "name"), "id")
    return counted.select("name", F.col("degree").alias("films")).orderBy(F.col("films").desc(), "name").limit(10)


@query("graph_directors_per_film", f"""
SELECT p_partkey + 1000000000000 AS film, p_name AS title, count(*) AS directors FROM {DIRECTED_SQL} JOIN part ON p_partkey = dst GROUP BY 1, 2 ORDER BY 3 DESC""")
def graph_directors_per_film(t: Tables) -> DataFrame:
    graph = src.film_graph(t)
    counted = g.degrees(graph.edges, "DIRECTED", "dst").join(graph.nodes.select("id", "title"), "id")
    return counted.select(F.col("id").alias("film"), "title", F.col("degree").alias("directors")).orderBy(F.col("directors").desc(), "film")


@query("graph_first3_per_actor", f"""
SELECT c_name AS name, p_name AS title, position FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY p_size, dst) AS position, p_name
  FROM {ACTED_SQL} a JOIN part ON p_partkey = dst) JOIN customer ON c_custkey = src WHERE position <= 3""")
def graph_first3_per_actor(t: Tables) -> DataFrame:
    """The three earliest films of each actor."""
    graph = src.film_graph(t)
    edges = graph.edges.where(F.col("type") == "ACTED_IN").select(F.col("src").alias("person"), F.col("dst").alias("film"))
    dated = g.attach(edges, graph.nodes, "film", "title", "released")
    first = g.first_per_source(dated, "person", [F.col("film_released"), F.col("film")], 3)
    return g.attach(first, graph.nodes, "person", "name").select(
        F.col("person_name").alias("name"), F.col("film_title").alias("title"), "position")


@query("graph_latest_film", f"""
SELECT c_name AS name, max(p_size) + 1990 AS latest, arg_max(p_name, CAST(p_size AS BIGINT) * 1000000000 + p_partkey) AS title, count(*) AS films
FROM {ACTED_SQL} a JOIN part ON p_partkey = dst JOIN customer ON c_custkey = src GROUP BY c_custkey, c_name""", bigint=["latest"])
def graph_latest_film(t: Tables) -> DataFrame:
    """Year and title of each actor's latest film, and how many films there are."""
    graph = src.film_graph(t)
    edges = graph.edges.where(F.col("type") == "ACTED_IN").select(F.col("src").alias("person"), F.col("dst").alias("film"))
    dated = g.attach(edges, graph.nodes, "film", "title", "released")
    latest = dated.groupBy("person").agg(
        F.max("film_released").alias("latest"),
        F.max_by("film_title", F.struct("film_released", "film")).alias("title"), F.count("*").alias("films"),
    )
    return g.attach(latest, graph.nodes, "person", "name").select(F.col("person_name").alias("name"), "latest", "title", "films")


@query("graph_cast_list", pages_sql(
    f"SELECT p_partkey + 1000000000000 AS film, p_name AS title, c_name AS v FROM {ACTED_SQL} a JOIN part ON p_partkey = dst JOIN customer ON c_custkey = src",
    "film, title", "players"))
def graph_cast_list(t: Tables) -> DataFrame:
    """The cast of every film, in pages, with its size."""
    graph = src.film_graph(t)
    edges = graph.edges.where(F.col("type") == "ACTED_IN").select(F.col("src").alias("person"), F.col("dst").alias("film"))
    named = g.attach(edges, src.people(t), "person", "name")
    pages = collect_pages(named, ["film"], F.col("person_name"), "players")
    return g.attach(pages, src.films(t), "film", "title").select(
        "film", F.col("film_title").alias("title"), "total", "page", F.array_join("players", ", ").alias("players"))


RATING_SQL = "(SELECT o_custkey AS src, l_partkey AS dst, CAST(l_quantity AS INTEGER) AS rating, 'line ' || l_linenumber AS summary FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"


@query("graph_top_rated_min_raters", f"""
SELECT p_partkey + 1000000000000 AS film, p_name AS title, sum(rating) / count(*) AS average, count(DISTINCT src) AS raters
FROM {RATING_SQL} JOIN part ON p_partkey = dst GROUP BY 1, 2 HAVING count(DISTINCT src) >= 30 ORDER BY 3 DESC, 1 LIMIT 5""")
def graph_top_rated_min_raters(t: Tables) -> DataFrame:
    """Best five films by average rating among those rated by at least thirty people."""
    rated = (
        src.reviews(t).groupBy("dst", "src").agg(F.sum("rating").alias("sum"), F.count("*").alias("n"))
        .groupBy("dst").agg((F.sum("sum") / F.sum("n")).alias("average"), F.count("*").alias("raters"))
        .where(F.col("raters") >= 30).orderBy(F.col("average").desc(), "dst").limit(5)
    )
    return g.attach(rated.withColumnRenamed("dst", "film"), src.films(t), "film", "title").select(
        "film", F.col("film_title").alias("title"), "average", "raters")


@query("graph_ratings_of_user", f"""
SELECT p_name AS title, rating FROM {RATING_SQL} JOIN part ON p_partkey = dst WHERE src = 3 ORDER BY 2 DESC""", bigint=["rating"])
def graph_ratings_of_user(t: Tables) -> DataFrame:
    """Films one user rated, best first."""
    start = src.people(t).where(F.col("id") == 3).select(F.col("id").alias("user"))
    rated = g.hop(start, src.reviews(t), "user", "film", ["REVIEWED"], properties=["rating"])
    return g.attach(rated, src.films(t), "film", "title").select(F.col("film_title").alias("title"), "rating").orderBy(F.col("rating").desc(), "title")


@query("graph_genres_of_actor", f"""
SELECT DISTINCT p_type AS genre FROM {ACTED_SQL} a JOIN customer ON c_custkey = src AND c_name = '{ACTOR}' JOIN part ON p_partkey = dst""")
def graph_genres_of_actor(t: Tables) -> DataFrame:
    """Genres of the films one actor played in."""
    genres = src.genres(t)
    genre_edges = t.part.select((F.col("p_partkey") + src.FILM_BASE).alias("src"), F.col("p_type").alias("name")).join(
        genres.select("name", F.col("id").alias("dst")), "name"
    ).select("src", "dst", F.lit("HAS_GENRE").alias("type"))
    tagged = g.hop(_played(t), genre_edges, "film", "genre")
    return g.attach(tagged, genres, "genre", "name").select(F.col("genre_name").alias("genre")).distinct()


@query("graph_top3_names_collect", """
SELECT string_agg(c_name, ', ' ORDER BY c_name DESC) AS names FROM (SELECT c_name FROM customer ORDER BY c_name DESC LIMIT 3)""")
def graph_top3_names_collect(t: Tables) -> DataFrame:
    """Order and cut first, then collect the three names in that order."""
    top = g.with_label(src.film_graph(t).nodes, "Person").select("name").orderBy(F.col("name").desc()).limit(3)
    return top.agg(F.array_join(F.sort_array(F.collect_list("name"), asc=False), ", ").alias("names"))


@query("graph_merge", """
WITH wanted AS (SELECT DISTINCT CASE WHEN s_acctbal < 5000 THEN 'Customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') ELSE s_name END AS name,
  CASE WHEN s_suppkey % 2 = 0 THEN 'Person' ELSE 'Director' END AS label FROM supplier)
SELECT c_custkey AS id, c_name AS name, 'Person' AS label, false AS created FROM customer
UNION ALL SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY name, label), name, label, true FROM wanted
WHERE label = 'Director' OR name NOT IN (SELECT c_name FROM customer)""")
def graph_merge(t: Tables) -> DataFrame:
    """Match or create people by name: the nodes afterwards, and which are new."""
    nodes = src.people(t).withColumn("created", F.lit(False))
    known = F.concat(F.lit("Customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"))
    wanted = t.supplier.select(
        F.array(F.when(F.col("s_suppkey") % 2 == 0, "Person").otherwise("Director")).alias("labels"),
        F.when(F.col("s_acctbal") < 5000, known).otherwise(F.col("s_name")).alias("name"), F.lit(True).alias("created"))
    return g.merge_nodes(nodes, wanted, ["name"]).select("id", "name", F.col("labels")[0].alias("label"), "created")


@query("graph_merge_edges", f"""
SELECT type, count(*) AS n FROM (SELECT src, dst, 'ACTED_IN' AS type FROM {ACTED_SQL} UNION SELECT src, dst, 'ACTED_IN' FROM {DIRECTED_SQL}
  UNION ALL SELECT src, dst, 'DIRECTED' FROM {DIRECTED_SQL}) GROUP BY 1""")
def graph_merge_edges(t: Tables) -> DataFrame:
    """Let every director act in the films they direct, unless they already do."""
    graph = src.film_graph(t)
    wanted = src.directed(t).withColumn("type", F.lit("ACTED_IN"))
    return g.merge_edges(graph.edges, wanted).groupBy("type").agg(F.count("*").alias("n"))


@query("graph_detach_delete", f"""
WITH dead AS (SELECT c_custkey AS id FROM customer WHERE c_name LIKE '%7')
SELECT 'node' AS what, count(*) AS n FROM (SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT id FROM dead) UNION ALL SELECT p_partkey FROM part)
UNION ALL SELECT 'ACTED_IN', count(*) FROM {ACTED_SQL} WHERE src NOT IN (SELECT id FROM dead)
UNION ALL SELECT 'DIRECTED', count(*) FROM {DIRECTED_SQL} WHERE src NOT IN (SELECT id FROM dead)""")
def graph_detach_delete(t: Tables) -> DataFrame:
    """What is left after deleting the people whose name ends in 7."""
    left = g.detach_delete(src.film_graph(t), F.col("name").endswith("7"))
    nodes = left.nodes.agg(F.lit("node").alias("what"), F.count("*").alias("n"))
    return nodes.unionByName(left.edges.groupBy(F.col("type").alias("what")).agg(F.count("*").alias("n")))


@query("graph_from_relational", """
SELECT 'Person' AS kind, count(*) AS n, 0 AS weight FROM customer UNION ALL SELECT 'Film', count(*), 0 FROM part UNION ALL SELECT 'Country', count(*), 0 FROM nation
UNION ALL SELECT 'LIVES_IN', count(*), 0 FROM customer JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT 'BOUGHT', count(*), CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def graph_from_relational(t: Tables) -> DataFrame:
    """Foreign keys and junction rows become edges, the country column becomes nodes."""
    countries = t.nation.select(
        (F.col("n_nationkey") + src.COUNTRY_BASE).alias("id"), F.array(F.lit("Country")).alias("labels"), F.col("n_name").alias("name"))
    nodes = src.people(t).unionByName(src.films(t), allowMissingColumns=True).unionByName(countries, allowMissingColumns=True)
    lives = t.customer.select(
        F.col("c_custkey").alias("src"), (F.col("c_nationkey") + src.COUNTRY_BASE).alias("dst"), F.lit("LIVES_IN").alias("type"))
    bought = src.reviews(t).select("src", "dst", F.lit("BOUGHT").alias("type"), F.col("rating").alias("weight"))
    edges = lives.unionByName(bought, allowMissingColumns=True)
    of_nodes = nodes.groupBy(F.get("labels", F.lit(0)).alias("kind")).agg(F.count("*").alias("n"), F.lit(0).cast("bigint").alias("weight"))
    of_edges = edges.groupBy(F.col("type").alias("kind")).agg(F.count("*").alias("n"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight"))
    return of_nodes.unionByName(of_edges)


@query("graph_reviews", f"""
SELECT c_name AS name, p_name AS title, rating, summary FROM {RATING_SQL} JOIN customer ON c_custkey = src JOIN part ON p_partkey = dst""", bigint=["rating"])
def graph_reviews(t: Tables) -> DataFrame:
    """Reviews with rating and text: properties that live on the edge."""
    edges = src.reviews(t).select(
        F.col("src").alias("person"), F.col("dst").alias("film"), "rating", "summary")
    found = g.attach(g.attach(edges, src.people(t), "person", "name"), src.films(t), "film", "title")
    return found.select(F.col("person_name").alias("name"), F.col("film_title").alias("title"), "rating", "summary")


@query("graph_update_property", """
SELECT p_partkey + 1000000000000 AS film, p_name AS title, p_size + 1990 AS before, 2005 AS after FROM part WHERE p_name = 'blue bolt'""", bigint=["before", "after"])
def graph_update_property(t: Tables) -> DataFrame:
    """Set a property of the films with one title; the year before and after."""
    from brindle.operators.changes import returning

    films = src.films(t).select("id", "title", "released")
    changes = films.where(F.col("title") == "blue bolt").select("id", F.lit(2005).alias("released"))
    return returning(films, changes, "id", ["released"]).select(
        F.col("id").alias("film"), "title", F.col("old_released").alias("before"), F.col("released").alias("after"))
