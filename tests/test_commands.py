"""The whole command log against a plain replay."""

import random
from collections import deque
from decimal import Decimal

import pytest

from brindle.operators import commands, queues
from tests.conftest import rows

SCHEMA = "seq bigint, op string, key string, item string, value string"


def plain_number(text):
    try:
        return Decimal(text)
    except ArithmeticError:
        return None


def shown(number):
    text = f"{number:f}"
    return text.rstrip("0").rstrip(".") if "." in text else text


def plain_replay(log):
    """(final rows, pops): one command after the other."""
    state, taken = {}, []
    for seq, op, key, item, value in sorted(log):
        if op == "del":
            state.pop(key, None)
            continue
        if op == "rename":
            if key != item and key in state:
                state[item] = state.pop(key)
            continue
        if op in commands.WRITES:
            state.setdefault(key, {"hash": {}, "set": set(), "zset": {}, "list": deque()})
        own = state.get(key)
        if own is None:
            if op in queues.POPS:
                taken.append((seq, op, key, None))
            continue
        if op == "set":
            own.clear()
            own.update({"string": value, "hash": {}, "set": set(), "zset": {}, "list": deque()})
        elif op == "incr":
            now = plain_number(own.get("string", "0"))
            if now is not None:
                own["string"] = shown(now + Decimal(value))
        elif op == "hset":
            own["hash"][item] = value
        elif op == "hdel":
            own["hash"].pop(item, None)
        elif op == "sadd":
            own["set"].add(item)
        elif op == "srem":
            own["set"].discard(item)
        elif op == "zadd":
            own["zset"][item] = Decimal(value)
        elif op == "zincrby":
            own["zset"][item] = own["zset"].get(item, Decimal(0)) + Decimal(value)
        elif op == "zrem":
            own["zset"].pop(item, None)
        elif op == "lpush":
            own["list"].appendleft(item)
        elif op == "rpush":
            own["list"].append(item)
        else:
            end = deque.popleft if op == "lpop" else deque.pop
            taken.append((seq, op, key, end(own["list"]) if own["list"] else None))
    final = []
    for key, own in state.items():
        if "string" in own:
            final.append((key, "string", None, own["string"]))
        final += [(key, "hash", f, v) for f, v in own["hash"].items()] + [(key, "set", m, None) for m in own["set"]]
        final += [(key, "zset", m, shown(s)) for m, s in own["zset"].items()]
        final += [(key, "list", i, str(k)) for k, i in enumerate(own["list"])]
    return sorted(final, key=str), sorted(taken)


def replayed(log):
    """Rows of `replay`, list items with their place instead of their slot."""
    found = commands.replay(log).collect()
    lists = {}
    for r in found:
        if r.kind == "list":
            lists.setdefault(r.key, []).append((r.pos, r.item))
    out = [(r.key, r.kind, r.item, r.value if r.kind != "zset" else shown(Decimal(r.value))) for r in found if r.kind != "list"]
    out += [(key, "list", item, str(k)) for key, own in lists.items() for k, (_, item) in enumerate(sorted(own))]
    return sorted(out, key=str)


def random_log(seed, n, names, with_set=True, with_rename=True, hot=None):
    rng = random.Random(seed)
    ops = ["incr", "hset", "hdel", "sadd", "srem", "zadd", "zincrby", "zrem"] + ["lpush", "rpush", "lpop", "rpop"] * 3
    ops += ["set"] * with_set + ["del", "rename", "rename"] * with_rename
    log = []
    for seq in range(1, n + 1):
        op = rng.choice(ops)
        key = hot if hot and rng.random() < 0.7 else rng.choice(names)
        item = rng.choice(names) if op == "rename" else f"i{seq}" if "push" in op else rng.choice("xyz")
        value = rng.choice(["Kim", "7", "0.004", "-12.5", ""]) if op == "set" else rng.choice(["1", "0.004", "-2.5", "10", "3.333333333333"])
        log.append((seq, op, key, item, value))
    return log


@pytest.mark.parametrize(("seed", "with_set", "with_rename"), [(1, False, False), (3, True, True)])
def test_replay_is_one_command_after_the_other(spark, seed, with_set, with_rename):
    log = random_log(seed, 600, list("abcdefgh"), with_set, with_rename)
    final, taken = plain_replay(log)
    df = spark.createDataFrame(log, SCHEMA).repartition(4)
    assert replayed(df) == final
    assert rows(commands.pops(df)) == sorted(taken, key=str)
    assert len(taken) > 50 and any(t[3] is None for t in taken) and any(t[3] for t in taken)


def test_one_list_with_most_commands(spark):
    log = random_log(9, 4000, list("abc"), with_set=False, with_rename=False, hot="a")
    final, taken = plain_replay(log)
    df = spark.createDataFrame(log, SCHEMA).repartition(4)
    assert replayed(df) == final and rows(commands.pops(df)) == sorted(taken, key=str)


def test_chains_of_renames(spark):
    names = [f"k{i}" for i in range(6)]
    log = [(1, "rpush", "k0", "first", None), (2, "set", "k3", None, "is overwritten")]
    log += [(10 + i, "rename", names[i], names[i + 1], None) for i in range(5)]
    log += [(30, "rpush", "k5", "second", None), (31, "rename", "none", "k5", None), (32, "lpop", "k5", None, None), (33, "rename", "k5", "k5", None)]
    df = spark.createDataFrame(log, SCHEMA)
    assert replayed(df) == [("k5", "list", "second", "0")] == plain_replay(log)[0]
    assert rows(commands.pops(df)) == [(32, "lpop", "k5", "first")]


def test_long_ways_take_few_rounds(spark, monkeypatch):
    """That a key exists is carried over sixty renames by doubling, not one after the other."""
    rounds, write = [], commands.materialize
    monkeypatch.setattr(commands, "materialize", lambda df, label="cut": rounds.append(label) or write(df, label))
    log = [(0, "rpush", "k0", "x", None), *[(k + 1, "rename", f"k{k}", f"k{k + 1}", None) for k in range(60)], (70, "rename", "no", "k60", None)]
    assert rows(commands.replay(spark.createDataFrame(log, SCHEMA)), "key", "item") == [("k60", "x")]
    assert rounds.count("reached") <= 10


def test_texts_and_exact_numbers(spark):
    log = [
        (1, "set", "name", None, "Kim"), (2, "incr", "name", None, "1"), (3, "zincrby", "z", "m", "0.004"), (4, "zincrby", "z", "m", "0.004"),
        (5, "incr", "n", None, "99999999999999999999"), (6, "incr", "n", None, "0.5"), (7, "set", "t", None, None), (8, "rpush", "q", None, None),
    ]
    found = {(r.key, r.kind, r.value) for r in commands.replay(spark.createDataFrame(log, SCHEMA)).collect()}
    assert found == {
        ("name", "string", "Kim"), ("z", "zset", "0.008"), ("n", "string", "99999999999999999999.5"), ("t", "string", None), ("q", "list", None),
    }


def test_unknown_commands_are_errors(spark):
    with pytest.raises(Exception, match="no such command: getset"):
        commands.replay(spark.createDataFrame([(1, "getset", "a", None, "1")], SCHEMA)).collect()


def test_empty_log_and_null_keys(spark):
    assert commands.replay(spark.createDataFrame([], SCHEMA)).collect() == []
    assert commands.pops(spark.createDataFrame([], SCHEMA)).collect() == []
    assert commands.replay(spark.createDataFrame([(1, "set", None, None, "x"), (2, "del", None, None, None)], SCHEMA)).collect() == []


def test_lists_with_null_keys_and_clear(spark):
    log = [(1, "rpush", None, "a"), (2, "rpush", None, "b"), (3, "clear", None, None), (4, "lpop", None, None), (5, "rpush", None, "c"), (6, "rpush", "x", "d"), (7, "rpop", "x", None)]
    tape = queues.placed(spark.createDataFrame(log, "seq bigint, op string, key string, item string"))
    assert rows(queues.taken(tape), "seq", "key", "item") == [(4, None, None), (7, "x", "d")]
    assert rows(queues.remaining(tape), "key", "item") == [(None, "c")]
