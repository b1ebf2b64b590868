"""One key holds a third of the rows: results stay right and the work stays spread."""

import pytest
from pyspark.sql import functions as F

from brindle.operators import ordering
from tests.conftest import rows

N = 6000


@pytest.fixture(autouse=True)
def many_slabs(spark):
    """Keep small slabs apart, so that keys run across them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def hot(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    return spark.range(N).select(key.alias("k"), F.pmod(F.col("id") * 7919, F.lit(N)).alias("o"), (F.col("id") % 5).alias("w"))


def grouped(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.k, []).append((r.o, r.w))
    return {k: sorted(v) for k, v in groups.items()}


def test_row_numbers(hot):
    expected = sorted(((k, o, i + 1, len(v)) for k, v in grouped(hot).items() for i, (o, _) in enumerate(v)), key=str)
    found = ordering.row_numbers(hot, ["k"], [F.col("o")], "n", total="size")
    assert rows(found, "k", "o", "n", "size") == expected


def test_row_numbers_of_the_whole_table(hot):
    found = ordering.row_numbers(hot, [], [F.col("o").desc()], "n", start=0)
    assert sorted((r.n, r.o) for r in found.collect()) == [(i, N - 1 - i) for i in range(N)]


def test_missing_keys_are_a_key(spark):
    df = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.lit("a")).alias("k"), "id")
    found = ordering.row_numbers(df, ["k"], [F.col("id")], "n").groupBy("k").agg(F.count("*"), F.max("n"), F.count_distinct("n"))
    assert rows(found) == [("a", 200, 200, 200), (None, 100, 100, 100)]
    before = ordering.previous(df, ["k"], [F.col("id")], "id", "b")
    assert before.count() == 300 and before.where("k is null and b = id - 3").count() == 99


def test_running_total(hot):
    expected = []
    for k, v in grouped(hot).items():
        total = 0
        for o, w in v:
            expected.append((k, o, total))
            total += w
    found = ordering.running_total(hot, ["k"], [F.col("o")], F.col("w"), "t")
    assert rows(found, "k", "o", "t") == sorted(expected, key=str)


def test_previous(hot):
    values = hot.withColumn("v", F.when(F.col("w") > 0, F.col("w")))  # a NULL is a value, too
    expected = []
    for k, v in grouped(hot).items():
        for i, (o, _) in enumerate(v):
            expected.append((k, o, (v[i - 1][1] or None) if i else None))
    found = ordering.previous(values, ["k"], [F.col("o")], "v", "b")
    assert rows(found, "k", "o", "b") == sorted(expected, key=str)


def test_hot_key_is_spread_over_slabs(hot):
    slabs, _ = ordering.in_slabs(hot, ["k"], [F.col("o")])
    sizes = [r.n for r in slabs.groupBy("_slab").agg(F.count("*").alias("n")).collect()]
    in_hot = slabs.where("k = 'hot'").select("_slab").distinct().count()
    assert in_hot >= 2 and max(sizes) < 0.5 * N


def test_top_per_key_trims_before_the_shuffle(hot):
    top = ordering.top_per_key(hot, ["k"], [F.col("o")], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert rows(top, "k", "o") == sorted(((k, o) for k, v in grouped(hot).items() for o, _ in v[:2]), key=str)


def test_top_per_key_beyond_the_trimming_limit(hot):
    top = ordering.top_per_key(hot, ["k"], [F.col("o")], 1500)
    counts = {r.k: r["count"] for r in top.groupBy("k").count().collect()}
    assert counts["hot"] == 1500 and sum(counts.values()) == N - 500


def test_range_by_index(hot):
    groups = grouped(hot)
    low = ordering.range_by_index(hot, ["k"], [F.col("o")], 1, 2)
    assert rows(low, "k", "o") == sorted(((k, o) for k, v in groups.items() for o, _ in v[1:3]), key=str)
    end = ordering.range_by_index(hot, ["k"], [F.col("o")], -2, -1)
    assert rows(end, "k", "o") == sorted(((k, o) for k, v in groups.items() for o, _ in v[-2:]), key=str)


def test_ranks_with_a_hot_tie(spark):
    df = spark.range(900).select(F.col("id"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("v"))
    data = [(r.id, r.v) for r in df.collect()]
    expected = sorted(((i, 1 + sum(b > v for _, b in data)) for i, v in data), key=str)
    assert rows(ordering.ranks(df, [], "v", "place"), "id", "place") == expected
