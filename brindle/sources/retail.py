"""The supermarket's tables, read from the order tables of a data folder.

A purchase is an order, a store is the nation of the buying customer, a
category is the part type, and a finished order counts as paid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.operators.retail import AMOUNT, Shop
from brindle.sources.tables import Tables

PRICE = "decimal(10,2)"


def headers(t: Tables) -> DataFrame:
    """Purchases without their store, which takes a join to find."""
    return t.orders.select(
        F.col("o_orderkey").alias("purchaseid"),
        F.col("o_orderdate").alias("purchasedatetime"),
        F.col("o_custkey").alias("customerid"),
    )


def purchases(t: Tables) -> DataFrame:
    homes = t.customer.select(F.col("c_custkey").alias("customerid"), F.col("c_nationkey").alias("storeid"))
    return headers(t).join(homes, "customerid", "left")


def items(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("purchaseid"),
        F.col("l_partkey").alias("productid"),
        F.col("l_suppkey").alias("supplierid"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("productid"),
        F.col("p_name").alias("productname"),
        F.col("p_retailprice").cast(PRICE).alias("price"),
        F.col("p_type").alias("categoryname"),
    )


def stores(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("storeid"),
        F.col("n_name").alias("storename"),
        F.col("r_name").alias("location"),
    )


def customers(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("customerid"),
        F.col("c_name").alias("customername"),
        F.concat(F.regexp_replace(F.lower("c_name"), "#", "-"), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("segment"),
    )


def suppliers(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("supplierid"), F.col("s_name").alias("suppliername")
    )


def payments(t: Tables) -> DataFrame:
    urgency = F.substring("o_orderpriority", 1, 1).cast("int")
    return t.orders.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("paymentid"),
        F.col("o_orderkey").alias("purchaseid"),
        F.when(urgency <= 2, "Card").when(urgency == 3, "Cash").otherwise("Voucher").alias("paymentmethod"),
        F.col("o_totalprice").cast(AMOUNT).alias("amount"),
    )


def shop(t: Tables, with_stores: bool = False) -> Shop:
    return Shop(
        purchases=purchases(t) if with_stores else headers(t),
        items=items(t), products=products(t), payments=payments(t), customers=customers(t),
        stores=stores(t), product_suppliers=items(t), suppliers=suppliers(t),
    )
