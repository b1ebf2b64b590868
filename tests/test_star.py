from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from brindle.operators import scd, star
from brindle.operators.ordering import ranks
from tests.conftest import rows


@pytest.fixture(scope="module")
def fact(spark):
    # Sample facts, from which the results below were worked out by hand.
    sales = spark.createDataFrame(
        [(1, 1, 1, 1, 1, 2, 5, "6.00"), (1, 1, 2, 2, 1, 1, 3, "2.40"), (2, 2, 3, 3, 2, 2, 2, "5.00"),
         (2, 2, 4, 4, 2, 2, 1, "1.50"), (3, 1, 1, 1, 2, 1, 10, "12.00"), (3, 1, 3, 3, 1, 2, 1, "2.50")],
        "datekey int, storekey int, productkey int, supplierkey int, customerkey int, paymentkey int, quantity int, amount string")
    return sales.select("*", F.col("amount").cast("decimal(18,2)").alias("salesamount"))


def test_sales_by_month_and_day(spark, fact):
    days = spark.createDataFrame([(1, 9, 18), (2, 9, 19), (3, 9, 20)], "datekey int, month int, day int")
    assert rows(star.sales_by(fact, days, "datekey", "month", "storekey")) == [(9, 1, D("22.90")), (9, 2, D("6.50"))]
    assert rows(star.sales_by(fact, days, "datekey", "day", "storekey")) == [
        (18, 1, D("8.40")), (19, 2, D("6.50")), (20, 1, D("14.50"))]


def test_category_and_rank(spark, fact):
    products = spark.createDataFrame(
        [(1, "Apple", "Fruit"), (2, "Banana", "Fruit"), (3, "Milk", "Dairy"), (4, "Bread", "Bakery")],
        "productkey int, productname string, category string")
    assert rows(star.sales_by(fact, products, "productkey", "category")) == [
        ("Bakery", D("1.50")), ("Dairy", D("7.50")), ("Fruit", D("20.40"))]
    ranked = ranks(star.sales_by(fact, products, "productkey", "productname"), [], "sales", "place")
    assert [(r.place, r.productname) for r in ranked.orderBy("place").collect()] == [
        (1, "Apple"), (2, "Milk"), (3, "Banana"), (4, "Bread")]


def test_rank_has_gaps_on_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 7), ("d", 1)], "name string, v int")
    assert rows(ranks(df, [], "v", "place"), "name", "place") == [("a", 2), ("b", 2), ("c", 1), ("d", 4)]


def versions(spark, data):
    return spark.createDataFrame(data, "sk long, id long, city string, validfrom date, validto date")


END = date(9999, 12, 31)


def test_type2_closes_and_adds(spark):
    state = versions(spark, [(1, 1, "Oslo", date(2025, 1, 1), END), (2, 2, "Bergen", date(2025, 1, 1), END)])
    changes = spark.createDataFrame(
        [(1, "Bergen", date(2025, 9, 21)), (2, "Bergen", date(2025, 9, 21))], "id long, city string, effective date")
    out = scd.apply_type2(state, changes, "id", ["city"], "sk")
    expected = [
        (1, 1, "Oslo", date(2025, 1, 1), date(2025, 9, 20)), (2, 2, "Bergen", date(2025, 1, 1), END),
        (3, 1, "Bergen", date(2025, 9, 21), END)]
    assert rows(out) == expected
    assert rows(scd.apply_type2(out, changes, "id", ["city"], "sk")) == expected  # idempotent


def test_type2_many_changes_unknown_keys_and_late_ones(spark):
    state = versions(spark, [(5, 1, "A", date(2025, 1, 1), date(2025, 1, 31)), (6, 1, "B", date(2025, 2, 1), END)])
    changes = spark.createDataFrame(
        [(1, "C", date(2025, 3, 1)), (1, "D", date(2025, 4, 1)), (1, "D", date(2025, 5, 1)), (1, "X", date(2024, 1, 1)),
         (9, "N", date(2025, 6, 1))], "id long, city string, effective date")
    out = scd.apply_type2(state, changes, "id", ["city"], "sk")
    assert rows(out) == [
        (5, 1, "A", date(2025, 1, 1), date(2025, 1, 31)), (6, 1, "B", date(2025, 2, 1), date(2025, 2, 28)),
        (7, 1, "C", date(2025, 3, 1), date(2025, 3, 31)), (8, 1, "D", date(2025, 4, 1), END), (9, 9, "N", date(2025, 6, 1), END)]
    facts = spark.createDataFrame([(1, date(2025, 1, 31)), (1, date(2025, 2, 28)), (1, date(2025, 7, 1))], "id long, day date")
    assert rows(scd.at_time(facts, out, "id", "day"), "day", "city") == [
        (date(2025, 1, 31), "A"), (date(2025, 2, 28), "B"), (date(2025, 7, 1), "D")]


def test_type2_null_is_a_value(spark):
    state = versions(spark, [(1, 1, None, date(2025, 1, 1), END)])
    changes = spark.createDataFrame([(1, None, date(2025, 3, 1)), (1, "A", date(2025, 4, 1)), (1, None, date(2025, 5, 1))],
                                    "id long, city string, effective date")
    out = scd.apply_type2(state, changes, "id", ["city"], "sk")
    assert rows(out, "city", "validfrom") == [("A", date(2025, 4, 1)), (None, date(2025, 1, 1)), (None, date(2025, 5, 1))]


def test_type1_overwrites(spark):
    state = spark.createDataFrame([(1, "Oslo"), (2, "Bergen")], "id long, city string")
    changes = spark.createDataFrame([(1, "Bergen", date(2025, 1, 2)), (1, "Harbour", date(2025, 1, 1))], "id long, city string, effective date")
    assert rows(scd.apply_type1(state, changes, "id", ["city"])) == [(1, "Bergen"), (2, "Bergen")]
