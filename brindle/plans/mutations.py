"""Changes to tables and documents, each as a function of state and changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle import stored
from brindle.operators import changes as ch
from brindle.operators import quality
from brindle.operators.ordering import row_numbers
from brindle.registry import query
from brindle.session import fresh_path
from brindle.sources import retail
from brindle.sources.tables import Tables

METHOD_SQL = """CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'Card'
  WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'Cash' ELSE 'Voucher' END"""


@query("update_store_returning", """
SELECT o_orderkey AS purchaseid, (c_nationkey + 1) % 25 AS storeid, c_nationkey AS old_storeid,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS purchasedate
FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT'""", bigint=["storeid", "old_storeid"])
def update_store_returning(t: Tables) -> DataFrame:
    """Move the urgent purchases to the next store and return them."""
    purchases = retail.purchases(t)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("purchaseid"))
    moves = purchases.join(urgent, "purchaseid", "left_semi").select(
        "purchaseid", ((F.col("storeid") + 1) % 25).alias("storeid")
    )
    return ch.returning(purchases, moves, "purchaseid", ["storeid"]).select(
        "purchaseid", "storeid", "old_storeid", F.to_date("purchasedatetime").alias("purchasedate")
    )


@query("guarded_email_update", """
WITH c AS (SELECT c_custkey AS customerid, replace(lower(c_name), '#', '-') || '@example.com' AS email, c_acctbal, c_mktsegment FROM customer),
claims AS (SELECT customerid, CASE WHEN c_acctbal > 5000 THEN 'vip-' || customerid || '@example.com'
    WHEN c_acctbal > 2500 THEN 'shared@example.com'
    ELSE replace(lower('Customer#' || lpad(CAST(customerid + 1 AS VARCHAR), 9, '0')), '#', '-') || '@example.com' END AS email
  FROM c WHERE c_mktsegment = 'BUILDING'),
won AS (SELECT email, min(customerid) AS customerid FROM claims WHERE email NOT IN (SELECT email FROM c) GROUP BY 1)
SELECT c.customerid, coalesce(won.email, c.email) AS email FROM c LEFT JOIN won USING (customerid)""")
def guarded_email_update(t: Tables) -> DataFrame:
    """Change e-mail addresses unless somebody holds the new one."""
    state = retail.customers(t).select("customerid", "email")
    balance = F.col("c_acctbal")
    neighbour = F.concat(F.lit("customer-"), F.lpad((F.col("c_custkey") + 1).cast("string"), 9, "0"), F.lit("@example.com"))
    claims = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("customerid"),
        F.when(balance > 5000, F.concat(F.lit("vip-"), F.col("c_custkey").cast("string"), F.lit("@example.com")))
        .when(balance > 2500, "shared@example.com").otherwise(neighbour).alias("email"),
    )
    allowed = ch.unused_only(claims, state, "customerid", "email")
    return ch.update_by_key(state, allowed, "customerid", ["email"])


@query("optimistic_price_change", """
SELECT p_partkey AS productid, p_name AS productname, CAST(CAST(CAST(p_retailprice AS DECIMAL(10,2)) + 5 AS DECIMAL(10,2)) AS DOUBLE) AS price
FROM part WHERE p_type = 'PROMO' AND p_size <= 25""")
def optimistic_price_change(t: Tables) -> DataFrame:
    """Raise prices where the expected old price still holds; big parts carry a stale one."""
    state = retail.products(t)
    stale = F.when(F.col("p_size") <= 25, F.lit(0)).otherwise(F.lit(1))
    asked = t.part.where(F.col("p_type") == "PROMO").select(
        F.col("p_partkey").alias("productid"),
        (F.col("p_retailprice").cast("decimal(10,2)") + stale).cast("decimal(10,2)").alias("expected"),
        (F.col("p_retailprice").cast("decimal(10,2)") + 5).cast("decimal(10,2)").alias("price"),
    )
    accepted = ch.matching_old(asked, state, "productid", "price", "expected")
    return ch.returning(state, accepted, "productid", ["price"]).select("productid", "productname", "price")


@query("upsert_payment", f"""
SELECT o_orderkey AS purchaseid, CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '5-LOW' THEN 'Cash' ELSE {METHOD_SQL} END AS paymentmethod,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount
FROM orders WHERE o_orderstatus IN ('F', 'P') OR (o_orderpriority = '5-LOW')""")
def upsert_payment(t: Tables) -> DataFrame:
    """Payments after a batch that changes some and adds others."""
    state = retail.payments(t).select("purchaseid", "paymentmethod", "amount")
    incoming = t.orders.where((F.col("o_orderstatus") == "P") | (F.col("o_orderpriority") == "5-LOW")).select(
        F.col("o_orderkey").alias("purchaseid"), F.lit("Cash").alias("paymentmethod"),
        F.col("o_totalprice").cast(retail.AMOUNT).alias("amount"),
    )
    return ch.upsert(state, incoming, "purchaseid")


@query("get_or_create_category", """
WITH old AS (SELECT p_type AS name, row_number() OVER (ORDER BY p_type) AS id FROM (SELECT DISTINCT p_type FROM part)),
moves AS (SELECT p_partkey, CASE p_brand WHEN 'Brand#1' THEN 'CLEARANCE' WHEN 'Brand#2' THEN 'PROMO' ELSE upper(split_part(p_name, ' ', 2)) END AS name
  FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')),
fresh AS (SELECT DISTINCT name FROM moves WHERE name NOT IN (SELECT name FROM old)),
cats AS (SELECT * FROM old UNION ALL SELECT name, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY name) FROM fresh)
SELECT p.p_partkey AS productid, cats.id AS categoryid, cats.name AS categoryname
FROM part p LEFT JOIN moves m ON m.p_partkey = p.p_partkey JOIN cats ON cats.name = coalesce(m.name, p.p_type)""")
def get_or_create_category(t: Tables) -> DataFrame:
    """Move products to categories by name, creating the categories that are missing."""
    names = t.part.select(F.col("p_type").alias("categoryname")).distinct()
    categories = row_numbers(names, [], [F.col("categoryname")], "categoryid").select("categoryname", "categoryid")
    target = (
        F.when(F.col("p_brand") == "Brand#1", "CLEARANCE").when(F.col("p_brand") == "Brand#2", "PROMO")
        .otherwise(F.upper(F.split("p_name", " ")[1]))
    )
    moves = t.part.where(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")).select(
        F.col("p_partkey").alias("productid"), target.alias("categoryname")
    )
    grown = ch.get_or_create(moves, categories, "categoryname", "categoryid")
    products = retail.products(t).select("productid", "categoryname")
    return ch.update_by_key(products, moves, "productid", ["categoryname"]).join(grown, "categoryname")


@query("doc_set_unset_inc", """
WITH d AS (SELECT conv_id || '-' || turn AS id, conv_id, turn, role, text FROM conversations),
f AS (SELECT min(id) AS id FROM d WHERE role = 'assistant')
SELECT id, conv_id, CASE WHEN turn = 0 THEN 'opener' ELSE role END AS speaker, CASE WHEN role = 'user' AND turn > 0 THEN NULL ELSE text END AS text,
  CASE WHEN role = 'assistant' THEN turn + 10 WHEN turn = 0 THEN turn ELSE turn END * CASE WHEN role = 'user' AND turn > 0 THEN 2 ELSE 1 END AS turn,
  CASE WHEN id = (SELECT id FROM f) THEN 1 END AS flagged
FROM d""", bigint=["flagged"])
def doc_set_unset_inc(t: Tables) -> DataFrame:
    """Set, unset, increment, multiply and rename fields of the messages."""
    messages = t.conversations.withColumn("id", F.concat_ws("-", "conv_id", "turn"))
    user_reply = (F.col("role") == "user") & (F.col("turn") > 0)
    out = ch.set_first(messages, F.col("role") == "assistant", "id", flagged=F.lit(1))
    out = ch.increment(out, F.col("role") == "assistant", turn=F.lit(10))
    out = ch.unset_where(out, user_reply, "text")
    out = ch.multiply(out, user_reply, turn=F.lit(2))
    out = ch.set_where(out, F.col("turn") == 0, role=F.lit("opener"))
    return out.withColumnRenamed("role", "speaker")


@query("doc_nested_set", """
WITH a AS (SELECT c_custkey AS id, c_name AS name, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Main street ' || c_custkey END AS street,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'NATION_' || c_nationkey END AS country, c_acctbal FROM customer)
SELECT id, name, CASE WHEN country IS NOT NULL AND c_acctbal < 3000 THEN 'Harbour 99' ELSE street END AS street, country,
  CASE WHEN name IN (SELECT s_name FROM supplier) OR c_acctbal > 8000 THEN true END AS known FROM a
UNION ALL SELECT NULL, s_name, NULL, NULL, true FROM supplier WHERE s_name NOT IN (SELECT c_name FROM customer)""")
def doc_nested_set(t: Tables) -> DataFrame:
    """Add a sub-document, change a field inside it, and upsert by filter."""
    docs = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                             "c_acctbal", "c_mktsegment", "c_nationkey")
    address = F.struct(
        F.concat(F.lit("Main street "), F.col("id").cast("string")).alias("street"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("country"),
    )
    out = ch.set_where(docs, F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), address=address)
    out = ch.set_nested(out, F.col("c_acctbal") < 3000, "address", street=F.lit("Harbour 99"))
    rich = docs.where(F.col("c_acctbal") > 8000).select("name")
    out = ch.upsert_matching(out, rich.unionByName(t.supplier.select(F.col("s_name").alias("name"))),
                             "name", known=F.lit(True))
    return out.select("id", "name", F.col("address.street").alias("street"),
                      F.col("address.country").alias("country"), "known")


@query("delete_where", """
SELECT c_custkey AS id, c_name AS name FROM customer
WHERE NOT coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END < 4000, false) AND NOT regexp_matches(c_name, '7$')""")
def delete_where(t: Tables) -> DataFrame:
    """Delete by a field that may be missing and by a pattern of the name."""
    docs = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                             F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("credit"))
    return ch.delete_where(ch.delete_where(docs, F.col("credit") < 4000), F.col("name").rlike("7$")).drop("credit")


@query("constraint_violations", f"""
SELECT 'item is unique' AS rule, l_orderkey || ',' || l_linenumber AS key, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'product name is unique', p_name, count(*) FROM part WHERE p_name IS NOT NULL GROUP BY p_name HAVING count(*) > 1
UNION ALL SELECT 'item has a purchase', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey
UNION ALL SELECT 'item has a product', CAST(l_partkey AS VARCHAR), count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part) GROUP BY l_partkey
UNION ALL SELECT 'purchase has a customer', CAST(o_custkey AS VARCHAR), count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey
UNION ALL SELECT 'customer has a name', CAST(c_custkey AS VARCHAR), 1 FROM customer WHERE c_name IS NULL
UNION ALL SELECT 'quantity is positive', l_orderkey || ',' || l_linenumber, 1 FROM lineitem WHERE NOT l_quantity > 0
UNION ALL SELECT 'method is known', CAST(o_orderkey AS VARCHAR), 1 FROM orders WHERE o_orderstatus = 'F' AND {METHOD_SQL} NOT IN ('Cash', 'Card', 'Voucher')
UNION ALL SELECT 'balance is not negative', CAST(c_custkey AS VARCHAR), 1 FROM customer WHERE NOT c_acctbal >= 0""")
def constraint_violations(t: Tables) -> DataFrame:
    """Rows that break the keys, references and checks of the shop's tables."""
    methods = ["Cash", "Card", "Voucher"]
    return quality.violations(
        quality.primary_key(t.lineitem, "item is unique", "l_orderkey", "l_linenumber"),
        quality.unique(t.part, "product name is unique", "p_name"),
        quality.references(t.lineitem, "item has a purchase", "l_orderkey", t.orders, "o_orderkey"),
        quality.references(t.lineitem, "item has a product", "l_partkey", t.part, "p_partkey"),
        quality.references(t.orders, "purchase has a customer", "o_custkey", t.customer, "c_custkey"),
        quality.present(t.customer, "customer has a name", "c_name", "c_custkey"),
        quality.check(t.lineitem, "quantity is positive", F.col("l_quantity") > 0, "l_orderkey", "l_linenumber"),
        quality.check(retail.payments(t), "method is known", F.col("paymentmethod").isin(methods), "purchaseid"),
        quality.check(t.customer, "balance is not negative", F.col("c_acctbal") >= 0, "c_custkey"),
    )


PAYMENT_FILES = 32


@query("stored_upsert", f"""
SELECT o_orderkey AS purchaseid, CASE WHEN o_orderkey BETWEEN 1000 AND 1200 THEN 'Cash' ELSE {METHOD_SQL} END AS paymentmethod,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount
FROM orders WHERE (o_orderstatus = 'F' OR o_orderkey BETWEEN 1000 AND 1200) AND o_orderkey NOT BETWEEN 2000 AND 2050""")
def stored_upsert(t: Tables) -> DataFrame:
    """Payments stored in files; a small change and a small deletion rewrite the few files they touch."""
    state = retail.payments(t).select("purchaseid", "paymentmethod", "amount")
    base = fresh_path(t.spark, "payments")
    stored.create(state, base, "purchaseid", PAYMENT_FILES)
    incoming = t.orders.where(F.col("o_orderkey").between(1000, 1200)).select(
        F.col("o_orderkey").alias("purchaseid"), F.lit("Cash").alias("paymentmethod"),
        F.col("o_totalprice").cast(retail.AMOUNT).alias("amount"),
    )
    stored.upsert(t.spark, base, "purchaseid", incoming)
    stored.delete(t.spark, base, "purchaseid", state.where(F.col("purchaseid").between(2000, 2050)))
    return stored.read(t.spark, base)
