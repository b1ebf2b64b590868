"""As-of joins by carrying, stored ranks, seen sets, and chains of moves."""

import random
from bisect import bisect_right
from collections import defaultdict

from pyspark.sql import functions as F

from brindle.operators import keyspace as kv
from brindle.operators import ranked, scd, seen
from brindle.session import fresh_path
from tests.conftest import rows


def test_as_of_takes_the_version_in_force(spark):
    rng = random.Random(1)
    starts = {k: sorted(rng.sample(range(1000), 40)) for k in "abc"}
    versions = [(k, s, s + 5 if i % 3 == 0 else None, f"{k}{s}") for k, own in starts.items() for i, s in enumerate(own)]
    facts = [(i, rng.choice([*"abcd", None]), rng.choice([None, *range(1000)])) for i in range(500)]
    end = {(k, s): e for k, s, e, _ in versions}
    expected = []
    for i, k, at in facts:
        place = bisect_right(starts.get(k, []), -1 if at is None else at) - 1
        if at is not None and place >= 0 and (end[k, starts[k][place]] is None or at <= end[k, starts[k][place]]):
            expected.append((i, f"{k}{starts[k][place]}"))
    dim = spark.createDataFrame(versions, "k string, validfrom int, validto int, name string")
    found = scd.as_of(spark.createDataFrame(facts, "id int, k string, at int"), dim, "k", "at")
    assert rows(found, "id", "name") == sorted(expected, key=str)
    assert rows(scd.as_of(spark.createDataFrame(facts, "id int, k string, at int"), dim.limit(0), "k", "at")) == []


def test_as_of_with_a_hundred_thousand_versions_of_one_key(spark):
    dim = spark.range(100_000).select(F.lit("hot").alias("k"), (F.col("id") * 10).alias("since"), F.col("id").alias("version"))
    facts = spark.range(50_000).select(F.lit("hot").alias("k"), (F.col("id") * 20 + 15).alias("at"), F.col("id").alias("fact"))
    found = scd.as_of(facts, dim, "k", "at", "since", None)
    assert found.count() == 50_000 and found.where(F.col("version") != F.col("fact") * 2 + 1).isEmpty()
    assert "BroadcastNestedLoop" not in found._jdf.queryExecution().toString()


def board(spark, n, seed=2):
    rng = random.Random(seed)
    members = [(k, f"m{i:04d}", rng.randrange(20)) for k in ("big", "small") for i in range(n if k == "big" else 30)]
    return members, spark.createDataFrame(members, "key string, member string, score int")


def test_stored_ranks_read_a_bucket_each(spark):
    members, zset = board(spark, 3000)
    stored = ranked.store(zset, fresh_path(spark, "board"), 30)
    order = defaultdict(list)
    for k, m, s in sorted(members, key=lambda r: (r[0], r[2], r[1])):
        order[k].append((m, s))
    asked = [("big", "m0007"), ("big", "m2999"), ("small", "m0029"), ("big", "nobody"), ("none", "m0001"), ("big", order["big"][0][0]), ("big", order["big"][-1][0])]
    place = {(k, m): (s, i, len(own) - 1 - i) for k, own in order.items() for i, (m, s) in enumerate(own)}
    found = ranked.ranks(stored, spark.createDataFrame([*asked, asked[0]], "key string, member string"))
    assert rows(found, "key", "member", "score", "rank", "revrank") == sorted(((*a, *place.get(a, (None,) * 3)) for a in set(asked)), key=str)
    index = spark.read.parquet(f"{stored.base}/index")
    assert index.select("bucket").distinct().count() >= 20 and index.agg(F.max("n")).first()[0] < 400
    one = ranked._buckets(spark, stored, "ordered", spark.createDataFrame([(3,)], "bucket int"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() < 400 and "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_stored_ranges(spark):
    members, zset = board(spark, 500)
    stored = ranked.store(zset, fresh_path(spark, "board"), 8)
    for key in ("big", "small", "none"):
        own = [(m, s) for _, s, m in sorted((k, s, m) for k, m, s in members if k == key)]
        for start, stop in ((0, 4), (100, 180), (-3, -1), (28, 40), (5, 2), (0, -1)):
            first, last = (start if start >= 0 else max(0, len(own) + start)), (stop if stop >= 0 else len(own) + stop)
            expected = [(i, *own[i]) for i in range(first, min(last, len(own) - 1) + 1)]
            found = ranked.rank_range(stored, spark, key, start, stop).select("rank", "member", "score").orderBy("rank")
            assert [tuple(r) for r in found.collect()] == expected


def test_a_filter_settles_what_was_never_seen(spark):
    base = fresh_path(spark, "seen")
    values = spark.range(0, 40_000, 2).selectExpr("id", "concat('v', id) AS v").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS id, CAST(NULL AS STRING) AS v"))
    kept = seen.store(values.unionByName(values), "v", base, 8)
    asked = spark.range(10_000).select("id", F.concat(F.lit("v"), "id").alias("v")).unionByName(spark.sql("SELECT 99999999L AS id, CAST(NULL AS STRING) AS v"))
    yes, no = seen.split(kept, asked, "v")
    assert yes.count() == 5000 and yes.where("id % 2 = 1").isEmpty() and no.count() == 5001
    through = seen.maybe(kept, asked.where("id % 2 = 1"), "v").count()
    assert 0 < through < 150  # of 5000 that were never seen
    assert seen.maybe(kept, asked.where("id % 2 = 0"), "v").count() == 5000
    assert "values" not in seen.maybe(kept, asked, "v")._jdf.queryExecution().toString()


def test_moves_along_chains_and_back(spark):
    rng = random.Random(4)
    log = []
    for seq in range(1, 900):
        op = rng.choice(["add", "add", "rem", "move", "move", "move"])
        log.append((seq, op, rng.choice("abcde"), f"m{rng.randrange(12)}", rng.choice("abcde") if op == "move" else None))
    state = set()
    for _, op, key, member, target in log:
        if op == "add":
            state.add((key, member))
        elif op == "rem":
            state.discard((key, member))
        elif key != target and (key, member) in state:
            state.remove((key, member))
            state.add((target, member))
    df = spark.createDataFrame(log, "seq int, op string, key string, member string, target string")
    assert rows(kv.set_state_with_moves(df), "key", "member") == sorted(state, key=str)
