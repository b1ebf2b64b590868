import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from brindle.operators import changes as ch
from brindle.operators import quality
from tests.conftest import rows


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "ava@x", 10), (2, "liam@x", 20), (3, None, 30)], "id int, email string, age int")


def test_update_and_returning(spark, people):
    new = spark.createDataFrame([(1, "new@x"), (3, None), (9, "nobody@x")], "id int, email string")
    assert rows(ch.update_by_key(people, new, "id", ["email"])) == [(1, "new@x", 10), (2, "liam@x", 20), (3, None, 30)]
    assert rows(ch.returning(people, new, "id", ["email"]), "id", "email", "old_email") == [(1, "new@x", "ava@x"), (3, None, None)]
    to_null = spark.createDataFrame([(1, None)], "id int, email string")
    assert rows(ch.update_by_key(people, to_null, "id", ["email"]))[0] == (1, None, 10)


def test_unused_only(spark, people):
    asked = spark.createDataFrame([(1, "liam@x"), (2, "free@x"), (3, "free@x")], "id int, email string")
    assert rows(ch.unused_only(asked, people, "id", "email")) == [(2, "free@x")]


def test_compare_and_set(spark, people):
    asked = spark.createDataFrame([(1, 10, 11), (2, 99, 21)], "id int, expected int, age int")
    assert rows(ch.matching_old(asked, people, "id", "age", "expected"), "id", "age") == [(1, 11)]


def test_upsert_is_idempotent(spark, people):
    new = spark.createDataFrame([(2, "l@y", 21), (4, "new@y", None)], "id int, email string, age int")
    once = ch.upsert(people, new, "id")
    assert rows(once) == [(1, "ava@x", 10), (2, "l@y", 21), (3, None, 30), (4, "new@y", None)]
    assert rows(ch.upsert(once, new, "id")) == rows(once)


def test_get_or_create_continues_from_the_greatest_id(spark):
    state = spark.createDataFrame([("Beverages", 101), ("Snacks", 104)], "name string, id int")
    wanted = spark.createDataFrame([("Snacks",), ("Toys",), ("Garden",), ("Toys",)], "name string")
    grown = ch.get_or_create(wanted, state, "name", "id")
    assert rows(grown) == [("Beverages", 101), ("Garden", 105), ("Snacks", 104), ("Toys", 106)]
    assert rows(ch.get_or_create(wanted, grown, "name", "id")) == rows(grown)


def test_set_unset_increment_multiply(people):
    is_two = F.col("id") == 2
    assert rows(ch.set_where(people, F.col("email") == "ava@x", age=F.lit(25)), "id", "age") == [(1, 25), (2, 20), (3, 30)]
    assert rows(ch.set_where(people, F.col("email") == "none@x", age=F.lit(0)), "age") == rows(people, "age")
    assert rows(ch.set_first(people, F.col("age") > 15, "id", flag=F.lit(1)), "id", "flag") == [(1, None), (2, 1), (3, None)]
    assert rows(ch.unset_where(people, is_two, "email"), "id", "email") == [(1, "ava@x"), (2, None), (3, None)]
    assert rows(ch.increment(people, is_two, age=F.lit(25)), "age") == [(10,), (30,), (45,)]
    assert rows(ch.multiply(people, is_two, age=F.lit(3)), "age") == [(10,), (30,), (60,)]


def test_increment_of_a_text_fails(spark):
    df = spark.createDataFrame([("gold", "4000"), ("name", "Wolverine")], "field string, value string")
    grow = F.col("value").cast("int") + 25
    assert df.where("field = 'gold'").select(grow.alias("v")).first().v == 4025
    with pytest.raises(PySparkException):
        df.select(grow.alias("v")).collect()


def test_nested_set_and_upsert(spark, people):
    address = F.struct(F.lit("Main 70").alias("street"), F.lit("Norway").alias("country"))
    homes = ch.set_where(people, F.col("id") == 1, address=address)
    moved = ch.set_nested(homes, F.lit(True), "address", street=F.lit("Harbour 99"))
    assert rows(moved, "id", "address.street", "address.country") == [(1, "Harbour 99", "Norway"), (2, None, None), (3, None, None)]
    asked = spark.createDataFrame([("liam@x",), ("kate@x",)], "email string")
    out = ch.upsert_matching(people, asked, "email", age=F.lit(7))
    assert rows(out, "id", "email", "age") == [(1, "ava@x", 10), (2, "liam@x", 7), (3, None, 30), (None, "kate@x", 7)]


def test_delete_keeps_missing(people):
    assert rows(ch.delete_where(people, F.col("email").rlike("^l")), "id") == [(1,), (3,)]


def test_constraints(spark):
    items = spark.createDataFrame([(1, 5, 2), (1, 5, 3), (2, 6, 0), (3, None, 1)], "p int, q int, n int")
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    found = quality.violations(
        quality.unique(items, "pk", "p", "q"), quality.references(items, "fk", "p", parents, "id"),
        quality.present(items, "not null", "q", "p"), quality.check(items, "positive", F.col("n") > 0, "p", "q"))
    assert rows(found) == [("fk", "3", 1), ("not null", "3", 1), ("pk", "1,5", 2), ("positive", "2,6", 1)]
