"""The star schema, its reports, and the customer dimension's history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle import stored
from brindle.functions.casts import cast_for_load
from brindle.functions.dates import minute_of_day
from brindle.operators import delta, scd, star
from brindle.operators.ordering import ranks
from brindle.registry import query
from brindle.session import fresh_path, materialize
from brindle.sinks import replace_all
from brindle.sources import retail
from brindle.sources.tables import Tables

LOAD_DAY = "2001-09-01"

DATE_SQL = """(SELECT row_number() OVER (ORDER BY first_seen) AS datekey, fulldate FROM
  (SELECT CAST(o_orderdate AS DATE) AS fulldate, min(o_orderkey) AS first_seen FROM orders GROUP BY 1))"""
FACT_SQL = f"""(SELECT l_orderkey AS saleid, datekey, c_nationkey AS storekey, l_partkey AS productkey,
  l_suppkey AS supplierkey, o_custkey AS customerkey, CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS paymentkey,
  CAST(l_quantity AS INTEGER) AS quantity,
  CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(18,2)) AS salesamount
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN {DATE_SQL} d ON fulldate = CAST(o_orderdate AS DATE))"""


def categories(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_type").alias("categoryname")).distinct()


def dates(t: Tables) -> DataFrame:
    stamps = t.orders.select(F.col("o_orderkey").alias("purchaseid"), F.col("o_orderdate").alias("purchasedatetime"))
    return star.dim_date(stamps)


def fact(t: Tables, days: DataFrame) -> DataFrame:
    """The whole fact, with every dimension key."""
    return star.fact_sales(
        retail.items(t), retail.products(t), retail.purchases(t), retail.payments(t), days
    )


def item_fact(t: Tables) -> DataFrame:
    """The fact with the keys an item has by itself: product, supplier, purchase."""
    return star.fact_sales(retail.items(t), retail.products(t))


def store_fact(t: Tables, days: DataFrame) -> DataFrame:
    return star.fact_sales(retail.items(t), retail.products(t), retail.purchases(t), dates=days)


@query("star_dim_date", f"""
SELECT datekey, CAST(fulldate AS VARCHAR) AS fulldate, year(fulldate) AS year, quarter(fulldate) AS quarter,
  month(fulldate) AS month, day(fulldate) AS day, dayname(fulldate) AS dayofweek FROM {DATE_SQL}""")
def star_dim_date(t: Tables) -> DataFrame:
    return dates(t)


@query("star_dim_product", """
SELECT p_partkey AS productkey, p_name AS productname, p_type AS category,
  CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS price, CAST(NULL AS VARCHAR) AS brand FROM part""")
def star_dim_product(t: Tables) -> DataFrame:
    return star.dim_product(retail.products(t), categories(t))


@query("star_dim_store", """
SELECT n_nationkey AS storekey, n_name AS storename, r_name AS city, CAST(NULL AS VARCHAR) AS region
FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""", bigint=["storekey"])
def star_dim_store(t: Tables) -> DataFrame:
    return star.dim_store(retail.stores(t))


@query("star_dim_supplier", """
SELECT s_suppkey AS supplierkey, s_name AS suppliername, CAST(NULL AS VARCHAR) AS contactinfo FROM supplier""")
def star_dim_supplier(t: Tables) -> DataFrame:
    return star.dim_supplier(retail.suppliers(t))


@query("star_dim_customer", f"""
SELECT c_custkey AS customerkey, c_name AS customername, 'Regular' AS segment, CAST(NULL AS VARCHAR) AS city,
  '{LOAD_DAY}' AS validfrom, '9999-12-31' AS validto FROM customer""")
def star_dim_customer(t: Tables) -> DataFrame:
    return star.dim_customer(retail.customers(t), LOAD_DAY)


@query("star_dim_payment", """
SELECT o_orderkey AS paymentkey, CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'Card'
  WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'Cash' ELSE 'Voucher' END AS paymenttype
FROM orders WHERE o_orderstatus = 'F'""")
def star_dim_payment(t: Tables) -> DataFrame:
    return star.dim_payment(retail.payments(t))


@query("star_dim_time", """
SELECT m // 60 AS hour, m % 60 AS minute, count(event_id) AS events
FROM range(1440) r(m) LEFT JOIN events ON hour(ts) * 60 + minute(ts) = m GROUP BY 1, 2""")
def star_dim_time(t: Tables) -> DataFrame:
    """Events per minute of the day, through the time dimension."""
    by_minute = t.events.groupBy(minute_of_day(F.col("ts")).alias("timekey")).agg(F.count("*").alias("events"))
    return star.dim_time().join(by_minute, "timekey", "left").select(
        "hour", "minute", F.coalesce("events", F.lit(0)).alias("events")
    )


@query("star_fact_sales", f"SELECT * REPLACE (CAST(salesamount AS DOUBLE) AS salesamount) FROM {FACT_SQL}", bigint=["storekey", "quantity"])
def star_fact_sales(t: Tables) -> DataFrame:
    return fact(t, dates(t))


@query("sales_by_month_store", f"""
SELECT month(fulldate) AS month, storekey, CAST(sum(salesamount) AS DOUBLE) AS sales
FROM {FACT_SQL} f JOIN {DATE_SQL} d USING (datekey) GROUP BY 1, 2""", bigint=["storekey"])
def sales_by_month_store(t: Tables) -> DataFrame:
    days = dates(t)
    return star.sales_by(store_fact(t, days), days, "datekey", "month", "storekey")


@query("sales_by_day_store", f"""
SELECT day(fulldate) AS day, storekey, CAST(sum(salesamount) AS DOUBLE) AS sales
FROM {FACT_SQL} f JOIN {DATE_SQL} d USING (datekey) GROUP BY 1, 2""", bigint=["storekey"])
def sales_by_day_store(t: Tables) -> DataFrame:
    days = dates(t)
    return star.sales_by(store_fact(t, days), days, "datekey", "day", "storekey")


@query("sales_by_category", f"""
SELECT p_type AS category, CAST(sum(salesamount) AS DOUBLE) AS sales
FROM {FACT_SQL} f JOIN part ON p_partkey = productkey GROUP BY 1""")
def sales_by_category(t: Tables) -> DataFrame:
    products = star.dim_product(retail.products(t), categories(t)).select("productkey", "category")
    return star.sales_by(item_fact(t), products, "productkey", "category")


@query("top_products_rank", f"""
SELECT rank() OVER (ORDER BY sum(salesamount) DESC) AS product_rank, p_name AS productname,
  CAST(sum(salesamount) AS DOUBLE) AS sales
FROM {FACT_SQL} f JOIN part ON p_partkey = productkey GROUP BY 2 ORDER BY 1""")
def top_products_rank(t: Tables) -> DataFrame:
    products = star.dim_product(retail.products(t), categories(t)).select("productkey", "productname")
    sales = star.sales_by(item_fact(t), products, "productkey", "productname")
    return ranks(sales, [], "sales", "product_rank").orderBy("product_rank", "productname")


@query("top_suppliers_rank", f"""
SELECT rank() OVER (ORDER BY sum(salesamount) DESC) AS supplier_rank, s_name AS suppliername,
  CAST(sum(salesamount) AS DOUBLE) AS sales
FROM {FACT_SQL} f JOIN supplier ON s_suppkey = supplierkey GROUP BY 2 ORDER BY 1""")
def top_suppliers_rank(t: Tables) -> DataFrame:
    """Suppliers ranked by sales: the flagship report."""
    sales = star.sales_by(item_fact(t), star.dim_supplier(retail.suppliers(t)), "supplierkey", "suppliername")
    return ranks(sales, [], "sales", "supplier_rank").orderBy("supplier_rank", "suppliername")


@query("avg_quantity_per_customer", f"""
SELECT c_custkey AS customerkey, avg(quantity) AS avg_quantity
FROM {FACT_SQL} f JOIN customer ON c_custkey = customerkey GROUP BY 1""")
def avg_quantity_per_customer(t: Tables) -> DataFrame:
    owners = t.orders.select(F.col("o_orderkey").alias("purchaseid"), F.col("o_custkey").alias("customerid"))
    sums = star.fact_sales(retail.items(t), retail.products(t), owners).groupBy("customerkey").agg(F.avg("quantity").alias("avg_quantity"))
    return sums.join(star.dim_customer(retail.customers(t), LOAD_DAY), "customerkey").select("customerkey", "avg_quantity")


@query("avg_basket_size", f"""
SELECT count(*) AS purchases, avg(basket) AS avg_basket FROM
  (SELECT saleid, sum(quantity) AS basket FROM {FACT_SQL} GROUP BY 1)""")
def avg_basket_size(t: Tables) -> DataFrame:
    """Products per purchase, averaged over all purchases."""
    baskets = item_fact(t).groupBy("saleid").agg(F.sum("quantity").alias("basket"))
    return baskets.agg(F.count("*").alias("purchases"), F.avg("basket").alias("avg_basket"))


@query("sales_grouping_sets", f"""
SELECT month, day, category, storekey, CAST(sum(salesamount) AS DOUBLE) AS sales FROM
  (SELECT month(fulldate) AS month, day(fulldate) AS day, p_type AS category, storekey, salesamount
   FROM {FACT_SQL} f JOIN {DATE_SQL} d USING (datekey) JOIN part ON p_partkey = productkey)
GROUP BY GROUPING SETS ((month, storekey), (day, storekey), (category))""", bigint=["storekey"])
def sales_grouping_sets(t: Tables) -> DataFrame:
    """Monthly, daily and category sales from one pass over the fact."""
    days = dates(t)
    sales = star.fact_sales(retail.items(t), retail.products(t), retail.purchases(t), dates=days, keep=["categoryname"])
    fine = (
        sales.groupBy("datekey", "storekey", F.col("categoryname").alias("category")).agg(F.sum("salesamount").alias("sales"))
        .join(days.select("datekey", "month", "day"), "datekey")
        .groupBy("month", "day", "storekey", "category").agg(F.sum("sales").alias("sales"))
    )
    sets = [["month", "storekey"], ["day", "storekey"], ["category"]]
    columns = ["month", "day", "category", "storekey"]
    return fine.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.sum("sales").alias("sales")
    )


@query("star_refresh_all", f"""
SELECT 'dimdate' AS name, count(*) AS rows, CAST(sum(datekey) AS DOUBLE) AS checksum FROM {DATE_SQL}
UNION ALL SELECT 'dimstore', count(*), sum(n_nationkey) FROM nation
UNION ALL SELECT 'dimproduct', count(*), sum(CAST(p_retailprice AS DECIMAL(10,2))) FROM part
UNION ALL SELECT 'dimsupplier', count(*), sum(s_suppkey) FROM supplier
UNION ALL SELECT 'dimcustomer', count(*), sum(c_custkey) FROM customer
UNION ALL SELECT 'dimpayment', count(*), sum(o_orderkey) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'factsales', count(*), sum(salesamount) FROM {FACT_SQL}""")
def star_refresh_all(t: Tables) -> DataFrame:
    """Rebuild all seven tables as one published version, then check what was loaded."""
    days = dates(t)
    checks = {
        "dimdate": (days, "datekey"),
        "dimstore": (star.dim_store(retail.stores(t)), "storekey"),
        "dimproduct": (star.dim_product(retail.products(t), categories(t)), "price"),
        "dimsupplier": (star.dim_supplier(retail.suppliers(t)), "supplierkey"),
        "dimcustomer": (star.dim_customer(retail.customers(t), LOAD_DAY), "customerkey"),
        "dimpayment": (star.dim_payment(retail.payments(t)), "paymentkey"),
        "factsales": (fact(t, days), "salesamount"),
    }
    loaded = replace_all(t.spark, {name: cast_for_load(df) for name, (df, _) in checks.items()})
    out = None
    for name, (_, column) in checks.items():
        one = loaded[name].agg(
            F.lit(name).alias("name"), F.count("*").alias("rows"),
            F.sum(F.col(column).cast("decimal(28,2)")).cast("double").alias("checksum"),
        )
        out = one if out is None else out.unionByName(one)
    return out


# --- history of the customer dimension -------------------------------------

# Two rounds of moves in one batch; some of them change nothing.
MOVES_SQL = """(SELECT c_custkey AS customerid, 'MACHINERY' AS segment, DATE '1997-06-01' AS effective FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
  UNION ALL SELECT c_custkey, 'BUILDING', DATE '1999-03-15' FROM customer WHERE c_acctbal < 2500)"""
SCD_SQL = f"""
line AS (SELECT c_custkey AS customerid, c_mktsegment AS segment, DATE '1995-01-01' AS effective FROM customer
  UNION ALL SELECT * FROM {MOVES_SQL}),
changed AS (SELECT * FROM line QUALIFY segment IS DISTINCT FROM lag(segment) OVER (PARTITION BY customerid ORDER BY effective)),
versions AS (SELECT customerid, segment, effective AS validfrom,
  coalesce(lead(effective) OVER (PARTITION BY customerid ORDER BY effective) - INTERVAL 1 DAY, DATE '9999-12-31')::DATE AS validto FROM changed),
added AS (SELECT customerid, validfrom, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY validfrom, customerid) AS sk
  FROM versions WHERE validfrom > DATE '1995-01-01'),
dim AS (SELECT coalesce(sk, v.customerid) AS customer_sk, v.* FROM versions v LEFT JOIN added a ON a.customerid = v.customerid AND a.validfrom = v.validfrom)"""


def _first_versions(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("customer_sk"), F.col("c_custkey").alias("customerid"),
        F.col("c_mktsegment").alias("segment"), F.lit("1995-01-01").cast("date").alias("validfrom"),
        F.lit("9999-12-31").cast("date").alias("validto"),
    )


def _versions(t: Tables) -> DataFrame:
    return scd.apply_type2(_first_versions(t), _moves(t), "customerid", ["segment"], "customer_sk")


def _moves(t: Tables) -> DataFrame:
    def move(where, segment, day):
        return t.customer.where(where).select(
            F.col("c_custkey").alias("customerid"), F.lit(segment).alias("segment"),
            F.lit(day).cast("date").alias("effective"),
        )

    return move(F.col("c_mktsegment") == "HOUSEHOLD", "MACHINERY", "1997-06-01").unionByName(
        move(F.col("c_acctbal") < 2500, "BUILDING", "1999-03-15")
    )


@query("scd1_overwrite", f"""
SELECT c_custkey AS customerid, coalesce((SELECT arg_max(segment, effective) FROM {MOVES_SQL} m WHERE m.customerid = c_custkey), c_mktsegment) AS segment
FROM customer""")
def scd1_overwrite(t: Tables) -> DataFrame:
    """Only the newest value is kept."""
    state = t.customer.select(F.col("c_custkey").alias("customerid"), F.col("c_mktsegment").alias("segment"))
    return scd.apply_type1(state, _moves(t), "customerid", ["segment"])


@query("scd2_apply", f"""WITH {SCD_SQL}
SELECT customer_sk, customerid, segment, CAST(validfrom AS VARCHAR) AS validfrom, CAST(validto AS VARCHAR) AS validto FROM dim""")
def scd2_apply(t: Tables) -> DataFrame:
    """Close the old version of each moved customer and add the new one."""
    return _versions(t)


@query("scd2_point_in_time", f"""WITH {SCD_SQL}
SELECT segment, count(*) AS purchases, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM orders JOIN dim ON customerid = o_custkey AND CAST(o_orderdate AS DATE) BETWEEN validfrom AND validto GROUP BY 1""")
def scd2_point_in_time(t: Tables) -> DataFrame:
    """Purchases by the segment the customer had on the day of purchase."""
    facts = t.orders.select(
        F.col("o_custkey").alias("customerid"), F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )
    # Many purchases of one customer and day need the dimension only once.
    daily = facts.groupBy("customerid", "day").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    return (
        scd.at_time(daily, _versions(t), "customerid", "day")
        .groupBy("segment").agg(F.sum("n").alias("purchases"), F.sum("amount").alias("amount"))
    )


@query("stored_scd2", f"""WITH {SCD_SQL}
SELECT customer_sk, customerid, segment, CAST(validfrom AS VARCHAR) AS validfrom, CAST(validto AS VARCHAR) AS validto FROM dim""")
def stored_scd2(t: Tables) -> DataFrame:
    """The history of customers as a stored table, of which only files with moved customers are rewritten."""
    base = fresh_path(t.spark, "customers")
    stored.create(_first_versions(t), base, "customerid", 16)
    moves = _moves(t)
    top = stored.read(t.spark, base).agg(F.max("customer_sk").alias("top"))
    stored.rewrite(
        t.spark, base, "customerid", moves, lambda rows: scd.apply_type2(rows, moves, "customerid", ["segment"], "customer_sk", top)
    )
    return stored.read(t.spark, base)


@query("scd2_as_of", f"""WITH {SCD_SQL}
SELECT o_orderkey AS purchaseid, customerid, segment, CAST(validfrom AS VARCHAR) AS validfrom
FROM orders JOIN dim ON customerid = o_custkey AND CAST(o_orderdate AS DATE) BETWEEN validfrom AND validto""")
def scd2_as_of(t: Tables) -> DataFrame:
    """Every purchase with the segment its customer had on that day, by one ordering of purchases and versions."""
    facts = t.orders.select(F.col("o_custkey").alias("customerid"), F.col("o_orderkey").alias("purchaseid"), F.to_date("o_orderdate").alias("day"))
    return scd.as_of(facts, _versions(t), "customerid", "day").select("purchaseid", "customerid", "segment", "validfrom")


# --- refresh by difference --------------------------------------------------

GROUPS = ["day", "storekey", "category"]
CHANGED_SQL = """price AS (
  SELECT p_partkey, p_type, CAST(p_retailprice AS DECIMAL(10,2)) + CASE WHEN p_partkey % 50 = 0 THEN 1 ELSE 0 END AS price FROM part
), head AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 200 = 1 THEN 7 ELSE c_nationkey END AS storekey
  FROM orders JOIN customer ON c_custkey = o_custkey
), line AS (
  SELECT l_orderkey, l_partkey, CASE WHEN l_orderkey % 97 = 5 THEN 1 ELSE CAST(l_quantity AS INT) END AS quantity FROM lineitem WHERE l_orderkey % 100 <> 3
  UNION ALL SELECT l_orderkey, l_partkey, 2 FROM lineitem WHERE l_orderkey % 150 = 4
)"""


def _source(t: Tables, changed: bool) -> dict[str, DataFrame]:
    """The tables behind the sales, as they were, or after new, changed and deleted items, prices and stores."""
    items, products, purchases = retail.items(t), retail.products(t), retail.purchases(t)
    if changed:
        number = F.col("purchaseid")
        left = items.where(number % 100 != 3).withColumn("quantity", F.when(number % 97 == 5, 1).otherwise(F.col("quantity")))
        items = left.unionByName(items.where(number % 150 == 4).withColumn("quantity", F.lit(2)))
        dearer = F.col("price") + F.when(F.col("productid") % 50 == 0, 1).otherwise(0)
        products = products.withColumn("price", dearer.cast(retail.PRICE))
        purchases = purchases.withColumn("storeid", F.when(number % 200 == 1, F.lit(7)).otherwise(F.col("storeid")))
    return {"items": items, "products": products, "purchases": purchases}


def _sales(source: Mapping[str, DataFrame]) -> DataFrame:
    days = source["purchases"].withColumn("day", F.to_date("purchasedatetime"))
    return star.fact_sales(source["items"], source["products"], days, keep=["categoryname"]).withColumnRenamed("categoryname", "category")


@query("star_refresh_delta", f"""WITH {CHANGED_SQL}
SELECT CAST(day AS VARCHAR) AS day, storekey, p_type AS category, count(*) AS rows, CAST(sum(CAST(quantity * price AS DECIMAL(18,2))) AS DOUBLE) AS salesamount
FROM line LEFT JOIN head ON o_orderkey = l_orderkey LEFT JOIN price ON p_partkey = l_partkey GROUP BY 1, 2, 3""", bigint=["storekey"])
def star_refresh_delta(t: Tables) -> DataFrame:
    """Daily sales by store and category, brought up to date with what changed in the tables."""
    old, new = _source(t, changed=False), _source(t, changed=True)
    kept = materialize(delta.tallied(_sales(old), GROUPS, ["salesamount"]), "sales")
    lookups = {"products": ("productid", "productid"), "purchases": ("purchaseid", "purchaseid")}
    changes = delta.signed_changes(_sales, old, new, "items", "purchaseid", lookups)
    return delta.refreshed(kept, changes, GROUPS, ["salesamount"])
