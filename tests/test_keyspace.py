from datetime import datetime

import pytest
from pyspark.sql import functions as F

from brindle.functions import arrays, maps
from brindle.functions.text import capitalise, glob_regex, part_of, strip_marks
from brindle.operators import commands
from brindle.operators import keyspace as kv
from brindle.operators import lists
from tests.conftest import rows


def test_arrays_as_lists(spark):
    depot = spark.createDataFrame([(["oak", "elm", "oak"],), ([],), (None,)], "items array<string>")
    c = F.col("items")
    grown = arrays.push_right(arrays.push_left(c, F.lit("ash")), F.lit("fir"))
    got = depot.where("size(items) = 3").select(
        grown.alias("grown"), arrays.insert_before(grown, F.lit("oak"), F.lit("yew")).alias("before"),
        arrays.insert_before(grown, F.lit("none"), F.lit("yew")).alias("same"), arrays.at(grown, 2).alias("third"),
        arrays.at(grown, -2).alias("last_but_one"), arrays.at(grown, 5).alias("outside"), arrays.slice_range(grown, 1, 3).alias("middle"),
        arrays.slice_range(grown, -3, -2).alias("from_end"), arrays.slice_range(grown, 4, 2).alias("void"),
        arrays.pop_left(grown).alias("l"), arrays.pop_right(grown).alias("r")).first()
    assert got.grown == got.same == ["ash", "oak", "elm", "oak", "fir"]
    assert got.before == ["ash", "yew", "oak", "elm", "oak", "fir"]
    assert (got.third, got.last_but_one, got.outside) == ("elm", "oak", None)
    assert got.middle == ["oak", "elm", "oak"] and got.from_end == ["elm", "oak"] and got.void == []
    assert (got.l.value, got.l.rest) == ("ash", ["oak", "elm", "oak", "fir"])
    assert (got.r.value, got.r.rest) == ("fir", ["ash", "oak", "elm", "oak"])
    none = depot.where("size(items) = 0").select(arrays.pop_right(c).alias("p")).first().p
    assert none.value is None and none.rest == []


def test_lists_as_a_table(spark):
    pushes = [("rpush", "a", 10), ("lpush", "a", 20), ("rpush", "b", 30), ("rpush", "a", 40), ("lpush", "a", 50), ("rpush", "a", 20)]
    log = spark.createDataFrame([(k + 1, op, key, str(v)) for k, (op, key, v) in enumerate(pushes)], "seq long, op string, key string, item string")

    def items(df, key):
        return [int(r.item) for r in df.where(F.col("key") == key).orderBy("pos", "sub").collect()]

    start = lists.from_pushes(log)
    assert items(start, "a") == [50, 20, 10, 40, 20] and items(start, "b") == [30]
    asked = "key string, pivot string, item string"
    once = lists.insert_before(start, spark.createDataFrame([("a", "20", "15"), ("b", "99", "1")], asked))
    assert items(once, "a") == [50, 15, 20, 10, 40, 20] and items(once, "b") == [30]
    twice = lists.insert_before(once, spark.createDataFrame([("b", "30", "25"), ("none", "1", "2")], asked))
    assert items(twice, "b") == [25, 30] and rows(lists.lengths(twice)) == [("a", 6), ("b", 2)]
    assert rows(lists.item_range(twice, -2, -1), "key", "position", "item") == [("a", 4, "40"), ("a", 5, "20"), ("b", 0, "25"), ("b", 1, "30")]
    first, rest = lists.pop(twice)
    last, rest = lists.pop(rest, left=False)
    assert rows(first, "key", "item") == [("a", "50"), ("b", "25")] and rows(last, "key", "item") == [("a", "20"), ("b", "30")]
    assert items(rest, "a") == [15, 20, 10, 40] and items(rest, "b") == []


def test_many_inserts_do_not_overflow(spark):
    held = spark.createDataFrame([("k", 1, 2**62, "x")], "key string, pos long, sub long, item string").withColumn("sub", F.lit(0).cast("bigint"))
    for k in range(5):
        held = lists.insert_before(held, spark.createDataFrame([("k", "x", f"n{k}")], "key string, pivot string, item string"))
    assert [r.item for r in held.orderBy("pos", "sub").collect()] == ["n0", "n1", "n2", "n3", "n4", "x"]
    assert held.agg(F.max("sub")).first()[0] == 0


def test_sets(spark):
    sets = spark.createDataFrame(
        [("even", k) for k in (2, 4, 6, 8, 12)] + [("thirds", k) for k in (3, 6, 9, 12)], "key string, member int")
    assert rows(kv.intersection(sets, "even", "thirds")) == [(12,), (6,)]
    assert kv.union(sets, "even", "thirds").count() == 7
    assert rows(kv.difference(sets, "thirds", "even")) == [(3,), (9,)]
    assert rows(kv.cardinality(sets)) == [("even", 5), ("thirds", 4)]
    asked = spark.createDataFrame([("even", 4), ("even", 9), ("thirds", 9), ("odd", 1)], "key string, member int")
    assert rows(kv.exists_many(sets, asked, ["key", "member"])) == [
        ("even", 4, True), ("even", 9, False), ("odd", 1, False), ("thirds", 9, True)]


def simulated(log):
    """Sets after a log of add, rem and move, one command after the other."""
    held = set()
    for _, op, key, member, target in sorted(log):
        if op == "add":
            held.add((key, member))
        elif op == "rem":
            held.discard((key, member))
        elif (key, member) in held:
            held.discard((key, member))
            held.add((target, member))
    return sorted(held)


def test_moves_in_chains(spark):
    import random

    rng, boxes = random.Random(4), ["red", "green", "blue"]
    log = []
    for seq in range(400):
        op = rng.choice(["add", "rem", "move", "move"])
        log.append((seq, op, rng.choice(boxes), f"m{rng.randint(0, 9)}", rng.choice(boxes) if op == "move" else None))
    df = spark.createDataFrame(log, "seq int, op string, key string, member string, target string")
    assert rows(kv.set_state_with_moves(df)) == simulated(log)


@pytest.fixture(scope="module")
def board(spark):
    changes = [("north", 12), ("south", 30), ("east", 7), ("north", 25), ("east", -2), ("west", 30), ("south", 1)]
    return kv.add_scores(spark.createDataFrame([("wind", m, float(d)) for m, d in changes], "key string, member string, delta double"))


def test_leaderboard(spark, board):
    assert [(r.rank, r.member, r.score) for r in kv.leaderboard(board, 2).orderBy("rank").collect()] == [(1, "north", 37.0), (2, "south", 31.0)]
    assert rows(kv.zrank(board), "member", "rank", "revrank") == [("east", 0, 3), ("north", 3, 0), ("south", 2, 1), ("west", 1, 2)]
    assert rows(kv.zrange(board, -2, -1), "member") == [("north",), ("south",)]
    assert rows(kv.zrange(board, 1, 2, descending=True), "member") == [("south",), ("west",)]
    asked = spark.createDataFrame([("wind", "west"), ("wind", "up"), ("rain", "west")], "key string, member string")
    assert rows(kv.zscore(board, asked), "key", "member", "score") == [("rain", "west", None), ("wind", "up", None), ("wind", "west", 30.0)]


def test_ties_go_by_member(spark):
    tied = spark.createDataFrame([("k", m, 1.0) for m in "bac"], "key string, member string, score double")
    assert rows(kv.zrank(tied), "member", "rank", "revrank") == [("a", 0, 2), ("b", 1, 1), ("c", 2, 0)]


COMMANDS = ["set", "incr", "incr", "del"]


def replayed(log):
    held = {}
    for _, op, key, value in sorted(log):
        if op == "del":
            held.pop(key, None)
        else:
            held[key] = value + (held.get(key, 0) if op == "incr" else 0)
    return sorted(held.items())


def test_replay(spark):
    import random

    rng = random.Random(9)
    log = [(seq, op := rng.choice(COMMANDS), f"k{rng.randint(0, 3) * rng.randint(0, 4)}", None if op == "del" else rng.randint(1, 50)) for seq in range(500)]
    df = spark.createDataFrame(log, "seq int, op string, key string, value int")
    assert rows(kv.replay(df, ["key"])) == replayed(log)
    unnamed = df.withColumn("key", F.when(F.col("key") != "k0", F.col("key")))
    assert dict(rows(kv.replay(unnamed, ["key"])))[None] == dict(replayed(log))["k0"]


def test_scores_are_set_added_to_and_removed(spark):
    log = [(1, "zincrby", "ann", 5), (2, "zadd", "ann", 40), (3, "zincrby", "ann", 2), (4, "zadd", "bob", 9), (5, "zrem", "bob", None),
           (6, "zincrby", "cat", 3), (7, "zrem", "dan", None)]
    df = spark.createDataFrame([(s, op, "cup", m, v) for s, op, m, v in log], "seq int, op string, key string, member string, score int")
    assert rows(kv.replay_scores(df)) == [("cup", "ann", 42), ("cup", "cat", 3)]


def test_mixed_log(spark):
    log = [
        (1, "hset", "cart:7", "colour", "teal"), (2, "hset", "cart:7", "size", "M"), (3, "hset", "cart:7", "colour", "plum"), (4, "hdel", "cart:7", "size", None),
        (5, "sadd", "tags", "new", None), (6, "sadd", "tags", "sale", None), (7, "srem", "tags", "new", None), (8, "zadd", "hits", "home", "4"),
        (9, "zincrby", "hits", "home", "3"), (10, "set", "visits", None, "10"), (11, "incr", "visits", None, "5"), (12, "hset", "cart:8", "size", "L"),
        (13, "del", "cart:8", None, None), (14, "set", "old", None, "1"), (15, "del", "old", None, None), (16, "incr", "old", None, "2")]
    df = spark.createDataFrame(log, "seq int, op string, key string, item string, value string")
    assert rows(commands.replay(df).drop("pos")) == [
        ("cart:7", "hash", "colour", "plum"), ("hits", "zset", "home", "7"), ("old", "string", None, "2"), ("tags", "set", "sale", None),
        ("visits", "string", None, "15")]


def test_strings_and_expiry(spark):
    at = datetime(2030, 5, 4, 8, 30)
    store = spark.createDataFrame(
        [("ticket", "A17", datetime(2030, 5, 4, 8, 31, 15)), ("menu", "soup", None), ("stale", "z", datetime(2030, 5, 4, 8, 30))],
        "key string, value string, expires_at timestamp_ntz")
    asked = spark.createDataFrame([("ticket",), ("menu",), ("stale",), ("absent",)], "key string")
    now = F.lit(at).cast("timestamp_ntz")
    assert rows(kv.ttl(store, asked, now)) == [("absent", -2), ("menu", -1), ("stale", -2), ("ticket", 75)]
    assert rows(kv.live(store, now), "key") == [("menu",), ("ticket",)]
    assert rows(kv.get_many(store, asked)) == [("absent", None), ("menu", "soup"), ("stale", "z"), ("ticket", "A17")]
    assert rows(kv.rename_key(store, "ticket", "menu"), "key", "value") == [("menu", "A17"), ("stale", "z")]
    assert rows(kv.rename_key(store, "absent", "menu"), "key") == rows(kv.rename_key(store, "menu", "menu"), "key") == rows(store, "key")
    assert rows(kv.delete_key(store, "stale", "menu"), "key") == [("ticket",)]


def test_hash_fields(spark):
    stones = spark.createDataFrame([("s:1", "granite", "3.5", "12"), ("s:2", "slate", None, "40"), ("s:3", "basalt", "9", None)],
                                   "id string, kind string, price string, stock string")
    hashes = kv.wide_to_hash(stones, F.col("id"), ["kind", "price", "stock"])
    assert hashes.count() == 7
    wide = kv.hash_to_wide(hashes, ["kind", "price", "stock"])
    assert rows(wide.where(F.col("price").cast("double") < 5), "key") == [("s:1",)]
    assert rows(wide.where(F.col("key") == "s:3")) == [("s:3", "basalt", "9", None)]
    record = F.create_map(F.lit("kind"), F.lit("slate"), F.lit("grain"), F.lit("fine"))
    changed = maps.delete_fields(maps.set_fields(record, kind=F.lit("marl"), seen=F.lit(3)), "grain")
    assert spark.range(1).select(maps.as_text(changed).alias("t")).first().t == "kind=marl,seen=3"


def test_fetch_fields(spark):
    hashes = spark.createDataFrame([("p:1", "name", "Quill"), ("p:1", "race", "Owl")], "key string, field string, value string")
    asked = spark.createDataFrame([("p:1",), ("p:2",)], "key string")
    assert rows(kv.fetch_fields(hashes, asked, "name", "gold")) == [
        ("p:1", "gold", None), ("p:1", "name", "Quill"), ("p:2", "gold", None), ("p:2", "name", None)]
    assert rows(kv.fetch_fields(hashes, asked)) == [("p:1", "name", "Quill"), ("p:1", "race", "Owl")]


def test_choices(spark):
    options = spark.sql("""SELECT 1 AS id, array(named_struct('item', named_struct('index', 'skill-a')), named_struct('item', named_struct('index', 'skill-b')),
      named_struct('item', named_struct('index', 'skill-c'))) AS options""")
    names = arrays.field_of_each(arrays.field_of_each(F.col("options"), "item"), "index")
    got = options.select(
        arrays.choose(names, F.lit(2), F.col("id")).alias("two"), arrays.choose(names, F.lit(0), F.col("id")).alias("none"),
        arrays.choose_up_to(names, 3, F.col("id")).alias("some"),
        arrays.choose_up_to(F.array().cast("array<string>"), 3, F.col("id")).alias("empty")).first()
    assert len(set(got.two)) == 2 and set(got.two) < {"skill-a", "skill-b", "skill-c"}
    assert got.none == [] and 1 <= len(got.some) <= 3 and got.empty == []


def test_patterns(spark):
    keys = spark.createDataFrame([(k,) for k in ("bus:4", "bus:42", "bus:4:stops", "tram:4", "bus.4", "bus:4:stops:x")], "key string")
    assert rows(kv.keys(keys, "bus:?")) == [("bus:4",)]
    assert rows(kv.keys(keys, "*:stops")) == [("bus:4:stops",)]
    assert rows(kv.keys(keys, "bus:4*")) == [("bus:4",), ("bus:42",), ("bus:4:stops",), ("bus:4:stops:x",)]
    assert glob_regex("x+?.*") == r"^x\+.\..*$"


def test_references(spark):
    hashes = spark.createDataFrame(
        [("bus:4", "colour", "green"), ("bus:9", "colour", "grey"), ("stop:a", "street", "Mill Lane"), ("stop:b", "street", "Quay"), ("stop:c", "zone", "2")],
        "key string, field string, value string")
    refs = spark.createDataFrame(
        [("bus:4:stops", "stop:a"), ("bus:4:stops", "stop:b"), ("bus:9:stops", "stop:b"), ("bus:9:stops", "stop:c"), ("bus:7:stops", "stop:a")],
        "key string, member string")
    line = F.concat_ws(":", part_of(F.col("key"), 0), part_of(F.col("key"), 1))
    followed = kv.follow(kv.follow(refs, hashes, line, "colour", "colour"), hashes, F.col("member"), "street", "street")
    assert rows(followed, "colour", "street") == [("green", "Mill Lane"), ("green", "Quay"), ("grey", "Quay")]


def test_stock_is_conserved(spark):
    requests = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("item"), F.col("id").alias("at"))
    stock = spark.createDataFrame([(1, 200), (4, 0), (5, 9)], "item long, quantity int")
    out = kv.allocate(requests, stock, "item", [F.col("at")], "quantity")
    per = {r.item: (r.yes, r.n) for r in out.groupBy("item").agg(F.sum(F.col("accepted").cast("int")).alias("yes"), F.count("*").alias("n")).collect()}
    assert per[1] == (200, 335) and per[4] == (0, 1) and per[5] == (1, 1) and per[7] == (0, 1)
    assert out.count() == 1000
    assert out.where("item = 1 and accepted").agg(F.max("at")).first()[0] < out.where("item = 1 and not accepted").agg(F.min("at")).first()[0]


def test_text_helpers(spark):
    df = spark.createDataFrame([("a,\"b'c`", 1, "gø")], "t string, n int, w string")
    assert strip_marks(df).first().t == "abc"
    assert df.select(capitalise(F.col("w")).alias("w")).first().w == "Gø"
