"""Star schema: dimensions and fact built from the day-to-day tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.dates import OPEN_END, calendar
from brindle.operators.ordering import row_numbers
from brindle.operators.skew import plain_side


def dim_date(purchases: DataFrame, grain: str = "day") -> DataFrame:
    """One row per purchase day (or time), keyed 1..n in order of first purchase."""
    stamp = F.col("purchasedatetime")
    full = F.to_date(stamp) if grain == "day" else stamp
    seen = purchases.groupBy(full.alias("fulldate")).agg(F.min("purchaseid").alias("first_seen"))
    keyed = row_numbers(seen, [], [F.col("first_seen"), F.col("fulldate")], "datekey")
    return keyed.select("datekey", "fulldate", *[c.alias(n) for n, c in calendar(F.col("fulldate")).items()])


def dim_store(stores: DataFrame) -> DataFrame:
    renamed = stores.withColumnsRenamed({"storeid": "storekey", "location": "city"})
    return renamed.withColumn("region", F.lit(None).cast("string"))


def dim_product(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with their category; a product without one is kept."""
    known = categories.select("categoryname", F.col("categoryname").alias("category"))
    return products.join(known, "categoryname", "left").select(
        F.col("productid").alias("productkey"),
        "productname",
        "category",
        "price",
        F.lit(None).cast("string").alias("brand"),
    )


def dim_supplier(suppliers: DataFrame) -> DataFrame:
    return suppliers.withColumnRenamed("supplierid", "supplierkey").withColumn(
        "contactinfo", F.lit(None).cast("string")
    )


def dim_customer(customers: DataFrame, as_of: str | None = None) -> DataFrame:
    """Customers as first versions, valid from `as_of` (today) with an open end."""
    start = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return customers.select(
        F.col("customerid").alias("customerkey"),
        "customername",
        F.lit("Regular").alias("segment"),
        F.lit(None).cast("string").alias("city"),
        start.alias("validfrom"),
        F.lit(OPEN_END).cast("date").alias("validto"),
    )


def dim_payment(payments: DataFrame) -> DataFrame:
    return payments.select(F.col("paymentid").alias("paymentkey"), F.col("paymentmethod").alias("paymenttype"))


def dim_time() -> DataFrame:
    """One row per minute of the day."""
    from pyspark.sql import SparkSession

    minutes = SparkSession.active().range(24 * 60)
    return minutes.select(
        F.col("id").alias("timekey"),
        F.floor(F.col("id") / 60).alias("hour"),
        F.pmod("id", F.lit(60)).alias("minute"),
    )


def fact_sales(
    items: DataFrame,
    products: DataFrame,
    purchases: DataFrame | None = None,
    payments: DataFrame | None = None,
    dates: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per purchase item; an unpaid purchase has no payment key.

    A purchase that is paid in parts has the key of its first payment, the one with
    the least id, so that its items are not multiplied.

    A report that needs no key of a table leaves that table out and saves its
    join. Payments and dates need `purchases`. `keep` names product columns that
    come along, so that a report on them need not join the products again.
    """
    amount = (F.col("quantity") * F.col("price")).cast("decimal(18,2)")
    fact = items.join(products.select("productid", "price", *keep), "productid", "left").withColumn("salesamount", amount)
    if purchases is not None:
        headers = purchases
        if payments is not None:
            paid = payments.groupBy("purchaseid").agg(F.min("paymentid").alias("paymentkey"))
            headers = headers.join(paid, "purchaseid", "left")
        if dates is not None:
            day = dates.select("datekey", F.col("fulldate").alias("_day"))
            headers = headers.join(day, F.to_date("purchasedatetime") == F.col("_day"), "left")
        headers = headers.drop("_day", "purchasedatetime")
        if payments is not None:
            # Already laid out by purchase; written, so that one with very many items can be split.
            headers = plain_side(headers)
        fact = fact.join(headers, "purchaseid", "left")
    keys = {"purchaseid": "saleid", "storeid": "storekey", "productid": "productkey",
            "supplierid": "supplierkey", "customerid": "customerkey"}
    return fact.drop("price").withColumnsRenamed(keys)


def sales_by(fact: DataFrame, dim: DataFrame, key: str, *group: str) -> DataFrame:
    """Sales summed by attributes of one dimension and, where given, fact keys.

    Sums by the dimension key first, so that the join sees one row per key.
    """
    fact_keys = [g for g in group if g in fact.columns and g != key]
    small = fact.groupBy(*dict.fromkeys([key, *fact_keys])).agg(F.sum("salesamount").alias("sales"))
    return small.join(dim, key).groupBy(*group).agg(F.sum("sales").alias("sales"))
