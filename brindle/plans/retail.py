"""Reports on the supermarket's day-to-day tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.operators import retail as reports
from brindle.operators.nesting import pages_sql
from brindle.registry import query
from brindle.sources.retail import shop
from brindle.sources.tables import Tables

PAY_SQL = "(SELECT o_orderkey AS purchaseid, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders WHERE o_orderstatus = 'F')"
AMOUNT_SQL = "CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2))"
DAY_SQL = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
MONTH_SQL = "CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR)"


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("purchasedate", F.to_date("purchasedatetime")).drop("purchasedatetime")


@query("unpaid_purchases", f"""
SELECT o_orderkey AS purchaseid, {DAY_SQL} AS purchasedate, c_name AS customername, n_name AS storename
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN {PAY_SQL} pay ON pay.purchaseid = o_orderkey
WHERE pay.purchaseid IS NULL ORDER BY o_orderdate DESC""")
def unpaid_purchases(t: Tables) -> DataFrame:
    return _dated(reports.unpaid(shop(t, with_stores=True)))


@query("orders_without_items", """
SELECT o_orderkey AS purchaseid, o_custkey AS customerid FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def orders_without_items(t: Tables) -> DataFrame:
    return reports.without_items(shop(t)).select("purchaseid", "customerid")


@query("last5_purchases_per_customer", f"""
WITH p AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 5),
i AS (SELECT l_orderkey, sum(CAST(l_quantity AS INTEGER)) AS n FROM lineitem GROUP BY 1),
s AS (SELECT purchaseid, sum(amount) AS paid FROM {PAY_SQL} GROUP BY 1)
SELECT c_custkey AS customerid, c_name AS customername, o_orderkey AS purchaseid, {DAY_SQL} AS purchasedate,
  CAST(n AS BIGINT) AS itemcount, CAST(paid AS DOUBLE) AS paidamount
FROM p JOIN customer ON c_custkey = o_custkey LEFT JOIN i ON l_orderkey = o_orderkey LEFT JOIN s ON s.purchaseid = o_orderkey""")
def last5_purchases_per_customer(t: Tables) -> DataFrame:
    return _dated(reports.last_purchases(shop(t)))


@query("store_revenue_in_range", f"""
SELECT c_nationkey AS storeid, CAST(sum(amount) AS DOUBLE) AS total_amount, count(*) AS transaction_count
FROM orders JOIN customer ON c_custkey = o_custkey JOIN {PAY_SQL} pay ON pay.purchaseid = o_orderkey
WHERE o_orderdate BETWEEN TIMESTAMP '1996-08-10 09:30:00' AND TIMESTAMP '1998-09-30 09:30:00' GROUP BY 1""", bigint=["storeid"])
def store_revenue_in_range(t: Tables) -> DataFrame:
    return reports.store_revenue(shop(t, with_stores=True), "1996-08-10 09:30:00", "1998-09-30 09:30:00")


@query("top5_products_last_n_days", f"""
SELECT p_partkey AS productid, p_name AS productname, CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS product_revenue
FROM part JOIN lineitem ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderdate >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 90 DAY
GROUP BY 1, 2 ORDER BY sum({AMOUNT_SQL}) DESC, 1 LIMIT 5""")
def top5_products_last_n_days(t: Tables) -> DataFrame:
    return reports.best_products(shop(t), "2001-08-01 12:00:00", 90)


@query("suppliers_of_product", pages_sql(
    "SELECT l_partkey AS productid, s_name AS v FROM lineitem JOIN supplier ON s_suppkey = l_suppkey",
    "productid", "suppliers"))
def suppliers_of_product(t: Tables) -> DataFrame:
    return reports.suppliers_of(shop(t))


@query("monthly_revenue_category_and_location", f"""
WITH x AS (SELECT p_type, r_name, {MONTH_SQL} AS month, {AMOUNT_SQL} AS amount
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
  JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
SELECT 'Category' AS type, p_type AS name, month, CAST(sum(amount) AS DOUBLE) AS revenue FROM x GROUP BY 2, 3
UNION ALL SELECT 'Store', r_name, month, CAST(sum(amount) AS DOUBLE) FROM x GROUP BY 2, 3""")
def monthly_revenue_category_and_location(t: Tables) -> DataFrame:
    return reports.monthly_revenue(shop(t, with_stores=True))


@query("monthly_revenue_yoy", f"""
WITH m AS (SELECT p_type AS category, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS revenue
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT a.category, CAST(a.month AS VARCHAR) AS month, a.revenue, b.revenue AS last_year,
  round((a.revenue - b.revenue) / b.revenue, 4) AS growth
FROM m a LEFT JOIN m b ON a.category = b.category AND b.month = a.month - INTERVAL 12 MONTH""")
def monthly_revenue_yoy(t: Tables) -> DataFrame:
    return reports.category_growth(shop(t))


@query("monthly_retention", f"""
WITH c AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)
SELECT CAST(a.month AS VARCHAR) AS month, count(DISTINCT a.o_custkey) AS retained_customers
FROM c a JOIN c b ON a.o_custkey = b.o_custkey AND b.month = a.month - INTERVAL 1 MONTH GROUP BY 1 ORDER BY 1""")
def monthly_retention(t: Tables) -> DataFrame:
    return reports.retention(shop(t))


@query("bestsellers_of_month", """
SELECT p_name AS productname, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS sold
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
WHERE date_trunc('month', o_orderdate) = DATE '1998-03-01' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def bestsellers_of_month(t: Tables) -> DataFrame:
    return reports.bestsellers_of_month(shop(t), "1998-03-01")


@query("global_count_and_distinct", """
SELECT 'part' AS name, count(*) AS rows, count(DISTINCT p_type) AS kinds FROM part
UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderpriority) FROM orders""")
def global_count_and_distinct(t: Tables) -> DataFrame:
    """Row count and number of distinct kinds of two tables."""
    def counted(name, df, kind):
        return df.agg(F.lit(name).alias("name"), F.count("*").alias("rows"), F.count_distinct(kind).alias("kinds"))

    return counted("part", t.part, "p_type").unionByName(counted("orders", t.orders, "o_orderpriority"))
