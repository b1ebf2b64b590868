"""Reports on a supermarket's day-to-day tables.

A report that takes a `Shop` reads only the tables and columns it needs, so the
others may be left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.dates import month_of, within_days
from brindle.operators.nesting import PAGE_ROWS, collect_pages
from brindle.operators.ordering import top_per_key
from brindle.session import materialize

AMOUNT = "decimal(18,2)"


@dataclass(frozen=True)
class Shop:
    """purchases(purchaseid, purchasedatetime, customerid, storeid) ·
    items(purchaseid, productid, quantity) · products(productid, productname, price, categoryname) ·
    payments(purchaseid, amount) · customers(customerid, customername) ·
    stores(storeid, storename, location) · product_suppliers(productid, supplierid) ·
    suppliers(supplierid, suppliername)
    """

    purchases: DataFrame = None
    items: DataFrame = None
    products: DataFrame = None
    payments: DataFrame = None
    customers: DataFrame = None
    stores: DataFrame = None
    product_suppliers: DataFrame = None
    suppliers: DataFrame = None


def amount_of(quantity: Column, price: Column) -> Column:
    """Quantity times price; Spark widens the product, so cast it back."""
    return (quantity * price).cast(AMOUNT)


def _revenue(name: str) -> Column:
    return F.sum(amount_of(F.col("quantity"), F.col("price"))).alias(name)


def unpaid(shop: Shop) -> DataFrame:
    """Purchases without a payment, newest first."""
    return (
        shop.purchases.join(shop.payments.select("purchaseid"), "purchaseid", "left_anti")
        .join(shop.customers.select("customerid", "customername"), "customerid")
        .join(shop.stores.select("storeid", "storename"), "storeid")
        .orderBy(F.col("purchasedatetime").desc(), F.col("purchaseid").desc())
        .select("purchaseid", "purchasedatetime", "customername", "storename")
    )


def without_items(shop: Shop) -> DataFrame:
    return shop.purchases.join(shop.items.select("purchaseid").distinct(), "purchaseid", "left_anti")


def last_purchases(shop: Shop, count: int = 5) -> DataFrame:
    """The last purchases of each customer with item count and paid amount.

    Items and payments are summed per purchase before they meet, so that one does
    not multiply the other; purchases are trimmed first.
    """
    newest = [F.col("purchasedatetime").desc(), F.col("purchaseid").desc()]
    purchases = shop.purchases.select("customerid", "purchaseid", "purchasedatetime")
    last = top_per_key(purchases, ["customerid"], newest, count)
    items = shop.items.groupBy("purchaseid").agg(F.sum("quantity").alias("itemcount"))
    paid = shop.payments.groupBy("purchaseid").agg(F.sum("amount").alias("paidamount"))
    return (
        last.join(shop.customers.select("customerid", "customername"), "customerid")
        .join(items, "purchaseid", "left")
        .join(paid, "purchaseid", "left")
        .select("customerid", "customername", "purchaseid", "purchasedatetime", "itemcount", "paidamount")
    )


def store_revenue(shop: Shop, start: str, end: str) -> DataFrame:
    """Revenue and number of paid purchases per store within a closed time range.

    A purchase paid in parts counts once. Payments of other times are left out before any sum.
    """
    bounds = [F.lit(x).cast("timestamp_ntz") for x in (start, end)]
    wanted = shop.purchases.where(F.col("purchasedatetime").between(*bounds)).select("purchaseid", "storeid")
    return (
        shop.payments.select("purchaseid", "amount").join(wanted, "purchaseid")
        .groupBy("purchaseid", "storeid").agg(F.sum("amount").alias("amount"))
        .groupBy("storeid")
        .agg(F.sum("amount").alias("total_amount"), F.count("*").alias("transaction_count"))
    )


def _sold(shop: Shop, purchases: DataFrame, *more: str) -> DataFrame:
    """Quantity per product (and `more`) of some purchases, summed before any price is looked up."""
    return (
        shop.items.select("purchaseid", "productid", "quantity")
        .join(purchases, "purchaseid")
        .groupBy("productid", *more).agg(F.sum("quantity").alias("quantity"))
    )


def best_products(shop: Shop, as_of: str, days: int, count: int = 5) -> DataFrame:
    """Best products by revenue in the days before `as_of`."""
    recent = shop.purchases.where(within_days(F.col("purchasedatetime"), as_of, days)).select("purchaseid")
    return (
        _sold(shop, recent).join(shop.products.select("productid", "productname", "price"), "productid")
        .select("productid", "productname", amount_of(F.col("quantity"), F.col("price")).alias("product_revenue"))
        .orderBy(F.col("product_revenue").desc(), "productid")
        .limit(count)
    )


def bestsellers_of_month(shop: Shop, month: str, count: int = 5) -> DataFrame:
    """Products sold most often in the month that starts on `month`."""
    start, at = F.lit(month).cast("timestamp_ntz"), F.col("purchasedatetime")
    in_month = (at >= start) & (at < start + F.expr("INTERVAL 1 MONTH"))
    return (
        _sold(shop, shop.purchases.where(in_month).select("purchaseid"))
        .join(shop.products.select("productid", "productname"), "productid")
        .groupBy("productname").agg(F.sum("quantity").alias("sold"))
        .orderBy(F.col("sold").desc(), "productname")
        .limit(count)
    )


def suppliers_of(shop: Shop, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Supplier names of every product as one ordered comma-joined text; beyond `page_rows` names it goes on in pages."""
    named = shop.product_suppliers.select("productid", "supplierid").join(shop.suppliers, "supplierid")
    pages = collect_pages(named, ["productid"], F.col("suppliername"), "suppliers", page_rows)
    return pages.withColumn("suppliers", F.array_join("suppliers", ", "))


def monthly_revenue(shop: Shop) -> DataFrame:
    """Revenue per month by category and by location, tagged, from one pass.

    Sums by month, category and store come first; both groupings read those.
    """
    dated = shop.purchases.select("purchaseid", "storeid", month_of(F.col("purchasedatetime")).alias("month"))
    fine = (
        _sold(shop, dated, "storeid", "month")
        .join(shop.products.select("productid", "price", "categoryname"), "productid")
        .groupBy("month", "categoryname", "storeid").agg(_revenue("revenue"))
        .join(shop.stores.select("storeid", "location"), "storeid")
    )
    category, location, month = F.col("categoryname"), F.col("location"), F.col("month")
    grouped = fine.groupingSets([[category, month], [location, month]], category, location, month).agg(
        F.sum("revenue").alias("revenue"), F.grouping("categoryname").alias("by_store")
    )
    by_category = F.col("by_store") == 0
    return grouped.select(
        F.when(by_category, "Category").otherwise("Store").alias("type"),
        F.when(by_category, category).otherwise(location).alias("name"),
        "month", "revenue",
    )


def category_growth(shop: Shop) -> DataFrame:
    """Monthly revenue per category and its change against the same month a year before.

    The year before is found by month, so missing months do not shift it. There is
    no growth over a year without revenue. The months are written once, being read twice.
    """
    dated = shop.purchases.select("purchaseid", month_of(F.col("purchasedatetime")).alias("month"))
    months = (
        _sold(shop, dated, "month")
        .join(shop.products.select("productid", "price", "categoryname"), "productid")
        .groupBy(F.col("categoryname").alias("category"), "month")
        .agg(_revenue("revenue"))
        .withColumn("revenue", F.col("revenue").cast("double"))
    )
    months = materialize(months, "months")
    later = months.select("category", F.add_months("month", 12).alias("month"), F.col("revenue").alias("last_year"))
    growth = F.try_divide(F.col("revenue") - F.col("last_year"), F.col("last_year"))
    return months.join(later, ["category", "month"], "left").withColumn("growth", F.round(growth, 4))


def retention(shop: Shop) -> DataFrame:
    """Customers of a month who had also bought in the month before."""
    active = shop.purchases.select("customerid", month_of(F.col("purchasedatetime")).alias("month")).distinct()
    month_after = active.withColumn("month", F.add_months("month", 1))
    # (customer, month) is unique on both sides: a plain count is the distinct count.
    return (
        active.join(month_after, ["customerid", "month"], "left_semi")
        .groupBy("month").agg(F.count("*").alias("retained_customers"))
        .orderBy("month")
    )
