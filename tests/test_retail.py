from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from brindle.operators import retail, star
from tests.conftest import rows


@pytest.fixture(scope="module")
def shop(spark):
    # Sample rows of a shop, from which the results below were worked out by hand.
    def table(data, schema):
        return spark.createDataFrame(data, schema)

    products = table(
        [(5001, "Coffee", "6.50", "Beverages"), (5002, "Tea", "4.00", "Beverages"), (5003, "Chips", "2.50", "Snacks"),
         (5004, "Soda", "1.75", "Beverages"), (5005, "Headphones", "49.99", "Electronics"),
         (5006, "Detergent", "8.99", "Household")],
        "productid int, productname string, price string, categoryname string",
    ).withColumn("price", F.col("price").cast("decimal(10,2)"))
    purchases = table(
        [(7001, "2025-09-27 10:15:00", 1001, 3001), (7002, "2025-09-27 18:40:00", 1002, 3002),
         (7003, "2025-09-26 12:05:00", 1001, 3001), (7004, "2025-09-20 09:30:00", 1003, 3001),
         (7005, "2025-08-15 14:20:00", 1004, 3002), (7006, "2025-09-29 16:50:00", 1002, 3001),
         (7007, "2025-09-30 08:10:00", 1003, 3002)],
        "purchaseid int, purchasedatetime string, customerid int, storeid int",
    ).withColumn("purchasedatetime", F.col("purchasedatetime").cast("timestamp_ntz"))
    payments = table(
        [(8001, 7001, "Card", "20.50"), (8002, 7003, "Cash", "21.98"), (8003, 7004, "Card", "13.50"),
         (8004, 7005, "Card", "99.98"), (8005, 7006, "Voucher", "21.49")],
        "paymentid int, purchaseid int, paymentmethod string, amount string",
    ).withColumn("amount", F.col("amount").cast("decimal(10,2)"))
    return retail.Shop(
        purchases=purchases,
        products=products,
        payments=payments,
        items=table(
            [(7001, 5001, 2), (7001, 5003, 3), (7002, 5005, 1), (7002, 5004, 2), (7003, 5002, 1), (7003, 5006, 2),
             (7004, 5001, 1), (7004, 5004, 4), (7005, 5005, 2), (7006, 5003, 5), (7006, 5006, 1), (7007, 5002, 3),
             (7007, 5004, 1)],
            "purchaseid int, productid int, quantity int"),
        customers=table(
            [(1001, "Ava Ng"), (1002, "Liam Chen"), (1003, "Sofia Rossi"), (1004, "Marco Dubois")],
            "customerid int, customername string"),
        stores=table([(3001, "Central Market", "Paris"), (3002, "Westside Outlet", "Lyon")],
                     "storeid int, storename string, location string"),
        product_suppliers=table(
            [(5001, 2001), (5001, 2002), (5002, 2002), (5003, 2001), (5004, 2001), (5004, 2002), (5005, 2003), (5006, 2001)],
            "productid int, supplierid int"),
        suppliers=table([(2001, "Acme Foods"), (2002, "Fresh Farm"), (2003, "TechSource")],
                        "supplierid int, suppliername string"),
    )


def test_unpaid_newest_first(shop):
    found = [tuple(r) for r in retail.unpaid(shop).select("purchaseid", "customername", "storename").collect()]
    assert found == [(7007, "Sofia Rossi", "Westside Outlet"), (7002, "Liam Chen", "Westside Outlet")]


def test_last_purchases_do_not_multiply_payments(shop):
    found = {r.purchaseid: (r.itemcount, r.paidamount) for r in retail.last_purchases(shop).collect()}
    assert found == {
        7007: (4, None), 7006: (6, D("21.49")), 7002: (3, None), 7001: (5, D("20.50")), 7003: (3, D("21.98")),
        7004: (5, D("13.50")), 7005: (2, D("99.98")),
    }
    assert rows(retail.last_purchases(shop, 1), "purchaseid") == [(7001,), (7005,), (7006,), (7007,)]


def test_store_revenue(shop):
    found = rows(retail.store_revenue(shop, "2025-08-10 09:30:00", "2025-09-30 09:30:00"))
    assert found == [(3001, D("77.47"), 4), (3002, D("99.98"), 1)]


def test_best_products(shop):
    best = retail.best_products(shop, "2025-09-30 12:00:00", 5).collect()
    assert [(r.productname, r.product_revenue) for r in best] == [
        ("Headphones", D("49.99")), ("Detergent", D("26.97")), ("Chips", D("20.00")), ("Tea", D("16.00")), ("Coffee", D("13.00"))]


def test_bestsellers_of_month(shop):
    best = retail.bestsellers_of_month(shop, "2025-09-01", 2).collect()
    assert [tuple(r) for r in best] == [("Chips", 8), ("Soda", 7)]


def test_suppliers_of_product(shop):
    found = retail.suppliers_of(shop).where("productid = 5004").select("suppliers").first()
    assert found.suppliers == "Acme Foods, Fresh Farm"


def test_monthly_revenue(shop):
    august, september = date(2025, 8, 1), date(2025, 9, 1)
    assert rows(retail.monthly_revenue(shop)) == sorted([
        ("Category", "Electronics", august, D("99.98")), ("Category", "Beverages", september, D("47.75")),
        ("Category", "Snacks", september, D("20.00")), ("Category", "Electronics", september, D("49.99")),
        ("Category", "Household", september, D("26.97")), ("Store", "Lyon", august, D("99.98")),
        ("Store", "Paris", september, D("77.47")), ("Store", "Lyon", september, D("67.24")),
    ], key=str)


def test_retention_is_empty(shop):
    assert retail.retention(shop).count() == 0


def test_growth_against_a_year_before(spark, shop):
    older = shop.purchases.withColumn("purchaseid", F.col("purchaseid") + 100).withColumn(
        "purchasedatetime", F.col("purchasedatetime") - F.expr("INTERVAL 1 YEAR"))
    items = shop.items.unionByName(shop.items.where("productid <> 5004").withColumn("purchaseid", F.col("purchaseid") + 100))
    both = retail.Shop(purchases=shop.purchases.unionByName(older), items=items, products=shop.products)
    found = retail.category_growth(both).where("category = 'Beverages' and month = '2025-09-01'").first()
    assert (found.revenue, found.last_year) == (47.75, 35.5)
    assert found.growth == round((47.75 - 35.5) / 35.5, 4)


def test_line_totals_in_the_fact(shop):
    dates = star.dim_date(shop.purchases)
    items = shop.items.withColumn("supplierid", F.lit(1))
    fact = star.fact_sales(items, shop.products, shop.purchases, shop.payments, dates)
    totals = {r.saleid: r.total for r in fact.groupBy("saleid").agg(F.sum("salesamount").alias("total")).collect()}
    assert totals == {7001: D("20.50"), 7002: D("53.49"), 7003: D("21.98"), 7004: D("13.50"), 7005: D("99.98"),
                      7006: D("21.49"), 7007: D("13.75")}
    unpaid = {r.saleid for r in fact.where("paymentkey is null").collect()}
    assert unpaid == {7002, 7007}
    first = dates.orderBy("datekey").first()
    assert (first.datekey, str(first.fulldate), first.dayofweek) == (1, "2025-09-27", "Saturday")
    assert dates.count() == 6  # two purchases share a day
    assert star.dim_date(shop.purchases, grain="time").count() == 7
