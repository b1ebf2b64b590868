import pytest
from pyspark.sql import functions as F

from brindle.functions.dates import object_id_time
from brindle.operators import changes as ch
from brindle.operators import documents as doc
from brindle.operators import nesting
from tests.conftest import rows


@pytest.fixture(scope="module")
def customers(spark):
    first = spark.createDataFrame([(1, "Jane", 25, "female")], "id int, name string, age int, gender string")
    more = spark.createDataFrame([(2, "Karim", 14, "male"), (3, "Kate", 75, "female")], "id int, name string, age int, gender string")
    phone = spark.createDataFrame([(4, "Ruben", 34, "male", 474612)], "id int, name string, age int, gender string, phone int")
    return doc.insert(doc.insert(first, more), phone)


@pytest.fixture(scope="module")
def movies(spark):
    # A small film collection, from which the results below were worked out by hand.
    person = spark.createDataFrame(
        [(1, "Charlie Sheen"), (2, "Michael Douglas"), (3, "Martin Sheen"), (4, "Morgan Freeman")], "id int, name string")
    film = spark.createDataFrame(
        [(1, "Wall Street", 1987), (2, "The American President", 1995), (3, "The Shawshank Redemption", 1994)], "id int, title string, year int")
    roles = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (2, 2), (3, 2), (4, 3)], "personid int, filmid int")
    return person, film, roles


def test_find_and_groups(customers):
    assert customers.where("phone is null").count() == 3
    assert rows(doc.find(customers, F.col("age") >= 16, "name")) == [("Jane",), ("Kate",), ("Ruben",)]
    assert rows(customers.groupBy("gender").agg(doc.exact_mean("age").alias("a"), F.count("*").alias("n"))) == [
        ("female", 50.0, 2), ("male", 24.0, 2)]
    assert doc.find_one(customers, "id").first().name == "Jane"
    assert [r.name for r in customers.orderBy("age").limit(2).collect()] == ["Karim", "Jane"]


def test_negation_matches_missing(customers):
    has_phone = F.col("phone") > 0
    assert doc.find(customers, doc.not_(has_phone)).count() == 3
    assert rows(doc.find(customers, doc.none_of(has_phone, F.col("gender") == "female")), "name") == [("Karim",)]
    assert rows(doc.find(customers, doc.any_of(has_phone, F.col("name") == "Jane")), "name") == [("Jane",), ("Ruben",)]
    assert doc.find(customers, doc.all_of(has_phone, F.col("name") == "Jane")).count() == 0


def test_deleting_males(customers):
    assert rows(ch.delete_where(customers, F.col("gender") == "male"), "name") == [("Jane",), ("Kate",)]


def test_lookup_unwind(movies):
    person, film, roles = movies
    step = nesting.lookup_unwind(roles, person, "personid", "id", "actor")
    pairs = nesting.lookup_unwind(step, film, "filmid", "id", "film").select("actor.name", "film.title")
    assert rows(pairs) == [
        ("Charlie Sheen", "Wall Street"), ("Martin Sheen", "The American President"), ("Martin Sheen", "Wall Street"),
        ("Michael Douglas", "The American President"), ("Michael Douglas", "Wall Street"), ("Morgan Freeman", "The Shawshank Redemption")]
    counts = pairs.groupBy("name").count()
    assert rows(counts) == [("Charlie Sheen", 1), ("Martin Sheen", 2), ("Michael Douglas", 2), ("Morgan Freeman", 1)]


def test_lookup_keeps_rows_without_a_match(movies):
    person, film, roles = movies
    found = nesting.lookup(film, roles.where("filmid < 3"), "id", "filmid", "cast", ["personid"])
    assert rows(found, "title", F.size("cast")) == [("The American President", 2), ("The Shawshank Redemption", 0), ("Wall Street", 3)]
    back = nesting.unwind(found, "cast").select("cast.personid", "cast.filmid")
    assert rows(back) == rows(roles.where("filmid < 3"))


def test_nineties_and_prefix(movies):
    person, film, _ = movies
    nineties = doc.find(film, (F.col("year") > 1990) & (F.col("year") < 2000), "title", "year").orderBy("year")
    assert [r.year for r in nineties.collect()] == [1994, 1995]
    assert rows(doc.find(person, F.col("name").rlike("^C"), "name")) == [("Charlie Sheen",)]
    assert rows(ch.delete_where(person, F.col("name").rlike("^M")), "name") == [("Charlie Sheen",)]


def test_pages_are_full_and_in_order(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    pages = nesting.collect_pages(df, ["k"], F.col("id"), "ids", page_rows=100)
    hot = pages.where("k = 'hot'").orderBy("page").collect()
    assert [len(r.ids) for r in hot] == [100] * 16 + [67] and {r.total for r in hot} == {1667}
    assert [i for r in hot for i in r.ids] == list(range(0, 5000, 3))
    assert pages.select(F.explode("ids")).count() == 5000


def test_pages_of_the_missing_key(spark):
    df = spark.range(60).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), "id")
    found = nesting.collect_pages(df, ["k"], F.col("id"), "ids", page_rows=100)
    assert rows(found.select("k", "total", F.size("ids"))) == [(1, 20, 20), (2, 20, 20), (None, 20, 20)]


def test_joined_pages_are_the_ordered_text(spark):
    import duckdb

    names = [(k % 3, f"name {(k * 37) % 41}") for k in range(200)] + [(1, None)]
    df = spark.createDataFrame(names, "k int, v string")
    whole = {}
    for r in nesting.collect_pages(df, ["k"], F.col("v"), "vs", page_rows=7).orderBy("k", "page").collect():
        whole[r.k] = whole.get(r.k, []) + r.vs
    values = ", ".join(f"({k}, {'NULL' if v is None else repr(v)})" for k, v in names)
    sql = f"SELECT k, string_agg(DISTINCT v, ', ' ORDER BY v) FROM (VALUES {values}) t(k, v) GROUP BY k"
    assert {k: ", ".join(vs) for k, vs in whole.items()} == dict(duckdb.sql(sql).fetchall())


def test_pages_keep_repeats_when_asked(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3)], "k int, v string, id int")
    assert nesting.collect_pages(df, ["k"], F.col("v"), "vs").first().vs == ["a", "b"]
    assert nesting.collect_pages(df, ["k"], F.col("v"), "vs", order=["id"]).first().vs == ["a", "a", "b"]


def test_object_id_time(spark):
    made = spark.createDataFrame([("507f1f77bcf86cd799439011",)], "_id string").select(object_id_time(F.col("_id")).alias("t"))
    assert made.select(F.unix_seconds("t").alias("s")).first().s == int("507f1f77", 16)
