"""Document-style queries: predicates, projections, groups, lookups and nesting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.arrays import field_of_each
from brindle.functions.dates import epoch_seconds, object_id_time
from brindle.functions.text import json_number
from brindle.operators import documents as doc
from brindle.operators.nesting import PAGE_ROWS, collect_pages, embed, lookup, lookup_unwind, pages_sql, unwind
from brindle.registry import query
from brindle.sources.tables import Tables


def people(t: Tables) -> DataFrame:
    """Customers as documents; `phone` is missing where the balance is low."""
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"), F.when(F.col("c_acctbal") > 4000, F.col("c_custkey")).alias("phone"),
    )


def films(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
        (F.col("p_size") + 1990).alias("year"), F.col("p_type").alias("genre"),
    )


def roles(t: Tables) -> DataFrame:
    """Who bought which part, as who played in which film."""
    buyers = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("personid"))
    return t.lineitem.select("l_orderkey", F.col("l_partkey").alias("filmid")).join(buyers, "l_orderkey").select(
        "personid", "filmid").distinct()


ROLES_SQL = "(SELECT DISTINCT o_custkey AS personid, l_partkey AS filmid FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"


@query("doc_find_project", """
SELECT 'first' AS found, c_name AS name, c_acctbal AS balance FROM customer WHERE c_custkey = (SELECT min(c_custkey) FROM customer)
UNION ALL SELECT 'building', c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'""")
def doc_find_project(t: Tables) -> DataFrame:
    first = doc.find_one(people(t), "id").select(F.lit("first").alias("found"), "name", "balance")
    building = doc.find(people(t), F.col("segment") == "BUILDING", "name", "balance")
    return first.unionByName(building.withColumn("found", F.lit("building")))


@query("doc_filter_or_and_nor", """
WITH p AS (SELECT c_custkey AS id, c_mktsegment AS segment, CASE WHEN c_acctbal > 4000 THEN c_custkey END AS phone FROM customer)
SELECT id, segment = 'BUILDING' OR coalesce(phone >= 700, false) AS any_of, segment = 'BUILDING' AND coalesce(phone >= 700, false) AS all_of,
  NOT coalesce(phone < 700, false) AS not_below, NOT (segment = 'BUILDING' OR coalesce(phone < 700, false)) AS none_of FROM p""")
def doc_filter_or_and_nor(t: Tables) -> DataFrame:
    """Which connectives each document meets; negations accept a missing phone."""
    building, phone = F.col("segment") == "BUILDING", F.col("phone")
    return people(t).select(
        "id", doc.any_of(building, phone >= 700).alias("any_of"), doc.all_of(building, phone >= 700).alias("all_of"),
        doc.not_(phone < 700).alias("not_below"), doc.none_of(building, phone < 700).alias("none_of"),
    )


@query("doc_range_sort", """
SELECT p_name AS title, p_size + 1990 AS year FROM part WHERE p_size + 1990 > 1990 AND p_size + 1990 < 2000 ORDER BY 2, 1""", bigint=["year"])
def doc_range_sort(t: Tables) -> DataFrame:
    """Films of the nineties from old to recent, both ends open."""
    stored = t.part.select(F.col("p_name").alias("title"), F.col("p_size").alias("since"), F.col("p_partkey").alias("id"))
    nineties = (F.col("since") > 0) & (F.col("since") < 10)  # years since 1990, as the scan knows them
    found = doc.find(stored, nineties).withColumn("year", F.col("since") + 1990)
    return found.orderBy("year", "title", "id").select("title", "year")


@query("doc_regex_prefix", "SELECT p_partkey AS id, p_name AS title FROM part WHERE regexp_matches(p_name, '^re')")
def doc_regex_prefix(t: Tables) -> DataFrame:
    return doc.find(films(t), F.col("title").startswith("re"), "id", "title")


@query("doc_in_list", """
SELECT c_name AS name, c_mktsegment AS segment FROM customer WHERE c_mktsegment IN ('FURNITURE', 'MACHINERY') ORDER BY c_acctbal DESC""")
def doc_in_list(t: Tables) -> DataFrame:
    wanted = F.col("segment").isin("FURNITURE", "MACHINERY")
    return doc.find(people(t), wanted).orderBy(F.col("balance").desc(), "id").select("name", "segment")


@query("doc_insert_heterogeneous", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS born, NULL AS role FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, 1950 + s_nationkey, 'Director' FROM supplier""", bigint=["born"])
def doc_insert_heterogeneous(t: Tables) -> DataFrame:
    """Documents with new fields join a collection that lacks them."""
    directors = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        (F.col("s_nationkey") + 1950).alias("born"), F.lit("Director").alias("role"),
    )
    return doc.insert(people(t).select("id", "name", "segment"), directors)


@query("doc_group_avg", """
SELECT CASE WHEN c_acctbal > 2000 THEN c_mktsegment END AS segment, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS average
FROM customer GROUP BY 1""")
def doc_group_avg(t: Tables) -> DataFrame:
    """Average per group; documents without the field form a group of their own."""
    some = people(t).withColumn("segment", F.when(F.col("balance") > 2000, F.col("segment")))
    return some.groupBy("segment").agg(doc.exact_mean("balance").alias("average"))


@query("doc_group_count", "SELECT c_mktsegment AS segment, count(*) AS total FROM customer GROUP BY 1")
def doc_group_count(t: Tables) -> DataFrame:
    return people(t).groupBy("segment").agg(F.count("*").alias("total"))


@query("doc_group_struct_key", f"""
SELECT c_custkey AS id, c_name AS name, count(*) AS totalfilms
FROM {ROLES_SQL} r JOIN customer ON c_custkey = personid JOIN part ON p_partkey = filmid GROUP BY 1, 2""")
def doc_group_struct_key(t: Tables) -> DataFrame:
    """Films per person, grouped by the pair (id, name)."""
    per_person = roles(t).join(films(t).select(F.col("id").alias("filmid")), "filmid", "left_semi")
    per_person = per_person.groupBy("personid").agg(F.count("*").alias("totalfilms"))
    return lookup_unwind(per_person, people(t).select("id", "name"), "personid", "id", "actor").select(
        "actor.id", "actor.name", "totalfilms"
    )


@query("doc_lookup_unwind", f"""
SELECT c_name AS actor_name, p_name AS film_title FROM {ROLES_SQL} r JOIN customer ON c_custkey = personid JOIN part ON p_partkey = filmid""")
def doc_lookup_unwind(t: Tables) -> DataFrame:
    """Actor and film of every role through two lookups."""
    with_actor = lookup_unwind(roles(t), people(t).select("id", "name"), "personid", "id", "actor")
    with_film = lookup_unwind(with_actor, films(t).select("id", "title"), "filmid", "id", "film")
    return with_film.select(F.col("actor.name").alias("actor_name"), F.col("film.title").alias("film_title"))


@query("doc_match_lookup", """
SELECT DISTINCT s_name AS name, s_nationkey + 1950 AS birthyear, p_partkey AS filmid
FROM part JOIN lineitem ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey WHERE p_name = 'red widget'""", bigint=["birthyear"])
def doc_match_lookup(t: Tables) -> DataFrame:
    """Directors of the films with one title: match first, look up after."""
    titled = doc.find(films(t), F.col("title") == "red widget").select(F.col("id").alias("filmid"))
    directed = t.lineitem.select(F.col("l_suppkey").alias("directorid"), F.col("l_partkey").alias("filmid"))
    directed = directed.join(titled, "filmid").distinct()
    born = t.supplier.select("s_suppkey", "s_name", (F.col("s_nationkey") + 1950).alias("born"))
    return lookup_unwind(directed, born, "directorid", "s_suppkey", "director").select(
        F.col("director.s_name").alias("name"), F.col("director.born").alias("birthyear"), "filmid"
    )


@query("doc_directed_collection", """
SELECT DISTINCT s_suppkey AS directorid, s_name AS directorname, p_partkey AS filmid, p_name AS filmtitle
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey""")
def doc_directed_collection(t: Tables) -> DataFrame:
    """A collection of who directed what, built from two lookups."""
    pairs = t.lineitem.select(F.col("l_suppkey").alias("directorid"), F.col("l_partkey").alias("filmid")).distinct()
    directors = t.supplier.select("s_suppkey", "s_name")
    named = lookup_unwind(pairs, directors, "directorid", "s_suppkey", "director")
    titled = lookup_unwind(named, films(t).select("id", "title"), "filmid", "id", "film")
    return titled.select("directorid", F.col("director.s_name").alias("directorname"), "filmid",
                         F.col("film.title").alias("filmtitle"))


@query("doc_add_to_set_match", f"""SELECT * FROM ({pages_sql(
    "SELECT p_name AS title, s_name AS v FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey",
    "title", "suppliers", 16)}) WHERE title LIKE 'red %' AND total >= 4""")
def doc_add_to_set_match(t: Tables) -> DataFrame:
    """Distinct supplier names per title, kept where the title and the set size fit."""
    red = doc.find(films(t), F.col("title").startswith("red "))  # the title is the group, so it can be met first
    titled = t.lineitem.select(F.col("l_partkey").alias("filmid"), F.col("l_suppkey").alias("supplierid")).join(
        red.select(F.col("id").alias("filmid"), "title"), "filmid")
    named = titled.join(t.supplier.select(F.col("s_suppkey").alias("supplierid"), "s_name"), "supplierid")
    sets = collect_pages(named, ["title"], F.col("s_name"), "suppliers", page_rows=16)
    return sets.where(F.col("total") >= 4).withColumn("suppliers", F.array_join("suppliers", ", "))


def _nested_sql(members: str, parents: str) -> str:
    """Pages of members in order; `members` selects side, id and v, `parents` selects side and id."""
    return f"""
WITH placed AS (SELECT *, row_number() OVER (PARTITION BY side, id ORDER BY v) - 1 AS place FROM ({members})),
pages AS (SELECT side, id, place // {PAGE_ROWS} AS page, string_agg(CAST(v AS VARCHAR), ',' ORDER BY place) AS members FROM placed GROUP BY ALL)
SELECT side, id, coalesce(page, 0) AS page, coalesce(members, '') AS members FROM ({parents}) LEFT JOIN pages USING (side, id)"""


def _listed(nested: DataFrame, side: str, column: str, field: str) -> DataFrame:
    members = F.transform(column, lambda m: m[field].cast("string"))
    return nested.select(F.lit(side).alias("side"), "id", F.col("page").cast("bigint").alias("page"), F.array_join(members, ",").alias("members"))


@query("doc_lookup_nested", _nested_sql(
    f"SELECT 'film' AS side, filmid AS id, personid AS v FROM {ROLES_SQL}", "SELECT 'film' AS side, p_partkey AS id FROM part"))
def doc_lookup_nested(t: Tables) -> DataFrame:
    """A lookup without unwind: each film with its roles nested; a film without roles has none."""
    found = lookup(films(t).select("id"), roles(t), "id", "filmid", "cast", ["personid"])
    return _listed(found, "film", "cast", "personid")


@query("doc_embed_both_ways", _nested_sql(
    f"SELECT 'person' AS side, personid AS id, filmid AS v FROM {ROLES_SQL} UNION ALL SELECT 'film', filmid, personid FROM {ROLES_SQL}",
    "SELECT 'person' AS side, c_custkey AS id FROM customer UNION ALL SELECT 'film', p_partkey FROM part"))
def doc_embed_both_ways(t: Tables) -> DataFrame:
    """Films embedded in people, and people embedded in films."""
    sides = [("person", people(t).select("id"), "personid", "filmid"), ("film", films(t).select("id"), "filmid", "personid")]
    listed = []
    for side, parents, own, other in sides:
        children = roles(t).select(F.col(own).alias("id"), other)
        nested = embed(parents, children, "id", [other], "members", identity=[other])
        listed.append(_listed(nested, side, "members", other))
    return listed[0].unionByName(listed[1])


@query("doc_sort_before_limit", "SELECT p_partkey AS id, p_name AS title FROM part ORDER BY p_size, p_partkey LIMIT 3")
def doc_sort_before_limit(t: Tables) -> DataFrame:
    """The three oldest films: the order counts before the limit, whatever was written first."""
    return doc.find(films(t), None, "id", "title", "year").orderBy("year", "id").limit(3).drop("year")


@query("doc_field_of_each", """
SELECT event_id, event_type || ',' || CAST(user_id AS VARCHAR) AS names FROM events""")
def doc_field_of_each(t: Tables) -> DataFrame:
    """One field of each object in an array."""
    objects = F.array(F.struct(F.col("event_type").alias("index")), F.struct(F.col("user_id").cast("string").alias("index")))
    return t.events.select("event_id", F.array_join(field_of_each(objects, "index"), ",").alias("names"))


@query("doc_relational_division", """
SELECT l_partkey AS productid, p_name AS productname
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey
GROUP BY 1, 2 HAVING count(DISTINCT n_regionkey) = (SELECT count(*) FROM region)""")
def doc_relational_division(t: Tables) -> DataFrame:
    """Products bought from every region."""
    origin = (
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        .join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
        .join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey")
        .select("l_orderkey", "n_regionkey")
    )
    reached = (
        t.lineitem.select("l_orderkey", "l_partkey").join(origin, "l_orderkey")
        .select("l_partkey", "n_regionkey").distinct()
        .groupBy("l_partkey").agg(F.count("*").alias("regions"))
    )
    every = t.region.agg(F.count("*").alias("n")).scalar()
    return reached.where(F.col("regions") == every).join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey"
    ).select(F.col("l_partkey").alias("productid"), F.col("p_name").alias("productname"))


@query("doc_embed_unembed", """
SELECT o_orderkey AS orderid, count(l_orderkey) AS lines, coalesce(sum(CAST(l_quantity AS BIGINT)), 0) AS quantity
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""", bigint=["quantity"])
def doc_embed_unembed(t: Tables) -> DataFrame:
    """Orders with their lines embedded; counts and sums are read from unwinding them."""
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("orderid"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"),
        F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    orders = t.orders.select(F.col("o_orderkey").alias("orderid"))
    embedded = embed(orders, lines, "orderid", ["part", "supplier", "line", "quantity"], "lines",
                     identity=["part", "supplier", "line"])
    sums = unwind(embedded, "lines").groupBy("orderid").agg(
        F.count("*").alias("lines"), F.sum("lines.quantity").alias("quantity"))
    return orders.join(sums, "orderid", "left").fillna(0, ["lines", "quantity"])


@query("doc_json_extract", "SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM events")
def doc_json_extract(t: Tables) -> DataFrame:
    return t.events.select("event_id", json_number(F.col("props"), "k").alias("k"))


@query("objectid_time", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS created FROM events")
def objectid_time(t: Tables) -> DataFrame:
    """Creation time decoded from 24-digit ids made of time and counter."""
    stamp = F.lpad(F.hex(epoch_seconds(F.col("ts"))), 8, "0")
    ids = t.events.select("event_id", F.lower(F.concat(stamp, F.lpad(F.hex("event_id"), 16, "0"))).alias("_id"))
    return ids.select("event_id", F.unix_seconds(object_id_time(F.col("_id"))).alias("created"))
