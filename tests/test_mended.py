"""Rows that reports must not drop, double or fail on, and plans that must reach the scan."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from brindle import registry, sinks
from brindle.operators import graph as g
from brindle.operators import nearest, ordering, quality, scd, star
from brindle.plans import load_all
from brindle.session import exists, fresh_path, tune
from brindle.streaming.runner import stored
from tests.conftest import rows

load_all()
FOLDER = "/root/testdata/sf0.001"


def test_ranks_keep_missing_values_and_keys(spark):
    df = spark.createDataFrame([("a", 5), ("a", None), ("a", 7), (None, 3), (None, 3), (None, 1)], "k string, v int")
    assert rows(ordering.ranks(df, ["k"], "v", "r"), "k", "v", "r") == sorted(
        [("a", 7, 1), ("a", 5, 2), ("a", None, 3), (None, 3, 1), (None, 3, 1), (None, 1, 3)], key=str)
    assert rows(ordering.ranks(df, [], "v", "r", descending=False), "v", "r") == sorted([(1, 1), (3, 2), (3, 2), (5, 4), (7, 5), (None, 6)], key=str)


def test_top_per_key_heeds_the_setting(spark):
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    df = spark.range(40).select((F.col("id") % 2).alias("k"), "id")
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        assert rows(ordering.top_per_key(df, ["k"], [F.col("id").desc()], 5), "id") == sorted(((k,) for k in range(30, 40)), key=str)
    finally:
        spark.conf.set(name, before)


def test_split_payments_do_not_double_sales(spark):
    items = spark.createDataFrame([(1, 10, 2), (1, 11, 1), (2, 10, 5)], "purchaseid int, productid int, quantity int")
    products = spark.createDataFrame([(10, 3.0), (11, None)], "productid int, price double")
    purchases = spark.createDataFrame([(1, 100, 7), (2, 100, 7)], "purchaseid int, storeid int, customerid int").withColumn(
        "purchasedatetime", F.lit("2030-01-02 03:04:05").cast("timestamp_ntz"))
    payments = spark.createDataFrame([(1, 51, 4.0), (1, 50, 2.0)], "purchaseid int, paymentid int, amount double")
    fact = star.fact_sales(items, products, purchases, payments)
    assert rows(fact, "saleid", "productkey", "paymentkey", F.col("salesamount").cast("double")) == sorted(
        [(1, 10, 50, 6.0), (1, 11, 50, None), (2, 10, None, 15.0)], key=str)


def test_growth_over_a_free_year(spark):
    from brindle.operators import retail

    class Shop:
        purchases = spark.createDataFrame([(1, "2030-01-05"), (2, "2031-01-05"), (3, "2032-01-05")], "purchaseid int, d string").select(
            "purchaseid", F.col("d").cast("timestamp_ntz").alias("purchasedatetime"))
        items = spark.createDataFrame([(1, 1, 2), (2, 2, 2), (3, 2, 3)], "purchaseid int, productid int, quantity int")
        products = spark.createDataFrame([(1, 0.0, "c"), (2, 5.0, "c")], "productid int, price double, categoryname string")

    got = retail.category_growth(Shop).orderBy("month").collect()
    assert [(r.revenue, r.last_year, r.growth) for r in got] == [(0.0, None, None), (10.0, 0.0, None), (15.0, 10.0, 0.5)]


def test_merged_nodes_have_ids_and_labels_count(spark):
    nodes = spark.createDataFrame([(4, ["Person"], "a"), (9, ["Person", "Pilot"], "c")], "id long, labels array<string>, name string")
    wanted = spark.createDataFrame([(["Person"], "b"), (["Pilot"], "b"), (["Pilot"], "b"), (["Pilot"], "c"), (["Pilot"], "a")], "labels array<string>, name string")
    got = g.merge_nodes(nodes, wanted, ["name"])
    assert rows(got, "id", "name", F.array_join("labels", "+")) == sorted(
        [(4, "a", "Person"), (9, "c", "Person+Pilot"), (10, "a", "Pilot"), (11, "b", "Person"), (12, "b", "Pilot")], key=str)


def test_closed_keys_are_not_reopened_in_the_past(spark):
    state = spark.createDataFrame([(1, "A", "x", date(2030, 1, 1), date(2030, 6, 30))], "sk long, k string, v string, validfrom date, validto date")
    changes = spark.createDataFrame([("A", "y", date(2030, 3, 1)), ("A", "z", date(2030, 8, 1)), ("B", "n", date(2030, 2, 2))], "k string, v string, effective date")
    got = scd.apply_type2(state, changes, "k", ["v"], "sk")
    assert rows(got, "k", "v", "validfrom") == [("A", "x", date(2030, 1, 1)), ("A", "z", date(2030, 8, 1)), ("B", "n", date(2030, 2, 2))]
    facts = spark.createDataFrame([("A", date(2030, 4, 1))], "k string, d date")
    assert scd.at_time(facts, got, "k", "d").count() == 1


def test_type1_takes_the_greatest_of_a_day(spark):
    state = spark.createDataFrame([("A", "x")], "k string, v string")
    changes = spark.createDataFrame([("A", v, date(2030, 3, 1)) for v in "mzq"], "k string, v string, effective date")
    for order in (changes, changes.orderBy("v"), changes.orderBy(F.col("v").desc())):
        assert rows(scd.apply_type1(state, order, "k", ["v"])) == [("A", "z")]


def test_unique_allows_missing_values_and_a_key_does_not(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("b", 4), ("b", 5)], "mail string, id int")
    assert rows(quality.unique(df, "u", "mail")) == [("u", "b", 2)]
    assert rows(quality.primary_key(df, "p", "mail")) == [("p", "NULL", 2), ("p", "b", 2)]


def test_points_without_a_position_stay(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 5.0), (3, 10.0, None), (4, 41.0, 9.0)], "id int, lat double, lon double")
    places = spark.createDataFrame([("p", 1.0, 1.0), ("q", 40.0, 10.0), ("lost", None, None)], "name string, lat double, lon double")
    got = nearest.nearest(points, places)
    assert rows(got, "id", "name") == [(1, "p"), (2, None), (3, None), (4, "q")]
    assert rows(nearest.nearest(points, places.limit(0)), "id", "name") == [(k, None) for k in (1, 2, 3, 4)]


def test_old_versions_go(spark):
    base = fresh_path(spark, "family")
    for k in range(4):
        now = sinks.replace_all(spark, {"t": spark.range(k + 1)}, base)
    assert now["t"].count() == 4
    assert spark.read.parquet(f"{base}/current").count() == 2


def test_only_a_missing_path_counts_as_no_batches(spark, tmp_path):
    like = spark.range(1)
    assert stored(spark, f"{tmp_path}/none", like).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("damaged")
    with pytest.raises(Exception):
        stored(spark, f"{tmp_path}/bad", like).count()
    assert not exists(spark, f"{tmp_path}/none")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, filters", [
    ("doc_in_list", ["In(c_mktsegment"]), ("doc_find_project", ["EqualTo(c_mktsegment,BUILDING)"]),
    ("doc_match_lookup", ["EqualTo(p_name,red widget)"]), ("doc_regex_prefix", ["StringStartsWith(p_name,re)"]), ("doc_range_sort", ["GreaterThan(p_size,0)", "LessThan(p_size,10)"]),
])
def test_filters_reach_the_scan(spark, name, filters):
    text = plan(registry.QUERIES[name](spark, FOLDER))
    assert all(f in text for f in filters)


def test_interval_reaches_the_scan(spark):
    from brindle.operators.pipeline import in_time_interval

    text = plan(in_time_interval(spark.read.parquet(f"{FOLDER}/events.parquet"), "ts", 1704672000, 1705881600))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_few_requests_leave_the_store_in_place(spark):
    from brindle.operators import keyspace as kv

    store = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select(F.col("l_orderkey").cast("string").alias("key"), F.col("l_partkey").alias("value"))
    got = kv.get_many(store, spark.createDataFrame([("1",), ("x",)], "key string"))
    text = plan(got)
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


def test_partitions_stay_small_however_much_is_shuffled(spark):
    """The session's number of shuffle partitions is no limit to how finely a large shuffle is cut."""
    tune(spark)
    cut = spark.range(4_000_000).select(F.xxhash64("id").alias("a"), F.xxhash64(F.col("id") + 1).alias("b")).distinct()
    assert cut.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
