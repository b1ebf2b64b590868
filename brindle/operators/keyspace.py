"""Key-value structures as long tables.

kv(key, value) · hash(key, field, value) · set(key, member) ·
zset(key, member, score) · log(seq, op, key, ...)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.text import key_like
from brindle.operators.ordering import SLAB, in_slabs, previous, range_by_index, row_numbers, top_per_key
from brindle.operators.skew import plain_side
from brindle.session import materialize


def key_of(namespace: str, *parts: Column) -> Column:
    return F.concat_ws(":", F.lit(namespace), *[p.cast("string") for p in parts])


# --- strings -------------------------------------------------------------------


def keys(store: DataFrame, pattern: str) -> DataFrame:
    return store.where(key_like(F.col("key"), pattern))


def _asked(store: DataFrame, requests: DataFrame, on: Sequence[str]) -> DataFrame:
    """The part of the store that is asked for. Few requests are broadcast, so the store itself is not shuffled."""
    return store.join(requests.select(*on).distinct(), list(on), "left_semi")


def get_many(store: DataFrame, requests: DataFrame) -> DataFrame:
    """A value for every requested key, NULL where the key is absent."""
    return requests.join(_asked(store.select("key", "value"), requests, ["key"]), "key", "left")


def exists_many(store: DataFrame, requests: DataFrame, on: Sequence[str] = ("key",)) -> DataFrame:
    """`present` for every request: is the key, or the (key, member), in the store?"""
    known = _asked(store.select(*on), requests, on).distinct().withColumn("present", F.lit(True))
    return requests.join(known, list(on), "left").withColumn("present", F.coalesce("present", F.lit(False)))


def last_write(log: DataFrame, on: Sequence[str], value: str, seq: str = "seq") -> DataFrame:
    return log.groupBy(*on).agg(F.max_by(value, seq).alias(value))


def rename_key(store: DataFrame, old: str, new: str) -> DataFrame:
    """Give a key another name; what the new name held before is gone. No such key, or the same name: no change."""
    if old == new:
        return store
    there = store.where(F.col("key") == old).limit(1).agg(F.count("*").alias("n")).scalar() > 0
    return store.where(~((F.col("key") == new) & there)).withColumn(
        "key", F.when(F.col("key") == old, new).otherwise(F.col("key"))
    )


def delete_key(store: DataFrame, *names: str) -> DataFrame:
    return store.where(~F.col("key").isin(list(names)))


def live(store: DataFrame, as_of: Column) -> DataFrame:
    """Keys that have not expired; a key without `expires_at` never does."""
    return store.where(F.col("expires_at").isNull() | (F.col("expires_at") > as_of))


def ttl(store: DataFrame, requests: DataFrame, as_of: Column) -> DataFrame:
    """Seconds left per requested key; -1 without expiry, -2 when absent or expired."""
    alive = _asked(live(store, as_of).select("key", "expires_at"), requests, ["key"]).withColumn("_alive", F.lit(True))
    left = F.unix_seconds(F.col("expires_at").cast("timestamp")) - F.unix_seconds(as_of.cast("timestamp"))
    remaining = F.when(F.col("_alive").isNull(), -2).when(F.col("expires_at").isNull(), -1).otherwise(left)
    return requests.join(alive, "key", "left").withColumn("ttl", remaining).drop("_alive", "expires_at")


# --- hashes --------------------------------------------------------------------


def hash_to_wide(hashes: DataFrame, fields: Sequence[str], value: str = "value") -> DataFrame:
    """One row per key with the named fields as columns; expects one value per (key, field)."""
    return hashes.groupBy("key").pivot("field", list(fields)).agg(F.first(value))


def wide_to_hash(df: DataFrame, key: Column, fields: Sequence[str]) -> DataFrame:
    """(key, field, value) rows from columns; NULL fields are absent."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    return df.select(key.alias("key"), F.inline(pairs)).where(F.col("value").isNotNull())


def fetch_fields(hashes: DataFrame, requests: DataFrame, *fields: str) -> DataFrame:
    """The named fields (or all that exist) of every requested key as (key, field, value).

    A named field that a key lacks has a NULL value.
    """
    if not fields:
        return requests.join(_asked(hashes, requests, ["key"]), "key").select("key", "field", "value")
    named = requests.withColumn("field", F.explode(F.array(*[F.lit(f) for f in fields])))
    return named.join(_asked(hashes, named, ["key", "field"]), ["key", "field"], "left").select("key", "field", "value")


# --- command log -----------------------------------------------------------------


def replay(log: DataFrame, on: Sequence[str]) -> DataFrame:
    """Final numbers of a log of `set`, `incr` and `del` commands.

    The last `set` or `del` of a key is its base: what came before is void. A key
    whose last word is a `del` is gone; increments after it start from 0. The log
    is cut into slabs by key and time; each slab gives its last base and what was
    added since, and the few slabs of a key are put together.
    """
    slabs, by = in_slabs(log.where(F.col("op").isin("set", "incr", "del")), on, [F.col("seq")])
    absolute = F.max(F.when(F.col("op").isin("set", "del"), F.col("seq"))).over(Window.partitionBy(*by, SLAB))
    current = slabs.withColumn("_base", absolute).where(F.col("_base").isNull() | (F.col("seq") >= F.col("_base")))
    value = F.when(F.col("op") != "del", F.col("value"))
    parts = current.groupBy(*by, SLAB).agg(
        F.sum(value).alias("value"), F.count(value).alias("_writes"), F.max("_base").alias("_base")
    )
    first = F.max(F.when(F.col("_base").isNotNull(), F.col(SLAB))).over(Window.partitionBy(*by))
    valid = parts.withColumn("_first", first).where(F.col("_first").isNull() | (F.col(SLAB) >= F.col("_first")))
    totals = valid.groupBy(*by).agg(F.sum("value").alias("value"), F.sum("_writes").alias("_writes")).where("_writes > 0")
    return totals.select(*(on if by == list(on) else [f"{by[0]}.*"]), "value")


# --- sets ------------------------------------------------------------------------


def set_state(log: DataFrame) -> DataFrame:
    """Members after a log of `add` and `rem`: those whose last word is `add`."""
    return last_write(log, ["key", "member"], "op").where(F.col("op") == "add").select("key", "member")


def set_state_with_moves(log: DataFrame) -> DataFrame:
    """Members after a log of `add`, `rem` and `move` (to `target`).

    A move takes effect only if the member was there; then it is also an `add` to
    the target, which later moves may build on. Only (key, member) pairs with a
    move are traced; after the first round only those that an arrival reached or
    left since. The log of all others is read once, for their last word.
    """
    log = log.where((F.col("op") != "move") | (F.col("key") != F.col("target"))).select("seq", "op", "key", "member", "target")
    pair = ["key", "member"]
    movers = materialize(log.where(F.col("op") == "move").select(*pair).distinct(), "movers")
    words = materialize(log.join(movers, pair, "left_semi"), "moving")
    # Arrivals with the pair that they come from, which is traced again when its own words change.
    arrivals = words.limit(0).select("seq", F.col("target").alias("key"), "member", F.col("key").alias("source"))
    todo = movers
    while not todo.isEmpty():
        sources = todo.withColumnRenamed("key", "source")
        come = arrivals.join(todo, pair, "left_semi").select("seq", F.lit("add").alias("op"), *pair)
        rows = words.join(todo, pair, "left_semi").unionByName(come, allowMissingColumns=True)
        traced = previous(rows, pair, [F.col("seq")], "op", "before").where((F.col("op") == "move") & (F.col("before") == "add"))
        found = materialize(traced.select("seq", F.col("target").alias("key"), "member", F.col("key").alias("source")), "found")
        known = arrivals.join(sources, ["source", "member"], "left_semi").select(*found.columns)
        differ = found.exceptAll(known).unionByName(known.exceptAll(found))
        todo = materialize(differ.select(*pair).distinct().join(movers, pair, "left_semi"), "todo")
        arrivals = materialize(arrivals.join(sources, ["source", "member"], "left_anti").unionByName(found), "arrivals")
    added = arrivals.select("seq", F.lit("add").alias("op"), *pair)
    return set_state(log.drop("target").unionByName(added))


def members(sets: DataFrame, key: str) -> DataFrame:
    return sets.where(F.col("key") == key).select("member")


def intersection(sets: DataFrame, a: str, b: str) -> DataFrame:
    return members(sets, a).intersect(members(sets, b))


def union(sets: DataFrame, a: str, b: str) -> DataFrame:
    return sets.where(F.col("key").isin(a, b)).select("member").distinct()


def difference(sets: DataFrame, a: str, b: str) -> DataFrame:
    return members(sets, a).subtract(members(sets, b))


def cardinality(sets: DataFrame) -> DataFrame:
    return sets.groupBy("key").agg(F.count("*").alias("size"))


# --- sorted sets -----------------------------------------------------------------


def _rising() -> list[Column]:
    return [F.col("score").asc(), F.col("member").asc()]


def _falling() -> list[Column]:
    """Highest score first; ties in reverse order of the member."""
    return [F.col("score").desc(), F.col("member").desc()]


def add_scores(changes: DataFrame) -> DataFrame:
    """Sorted sets from increments: the scores of a (key, member) add up."""
    return changes.groupBy("key", "member").agg(F.sum("delta").alias("score"))


def replay_scores(log: DataFrame) -> DataFrame:
    """Sorted sets from a log(seq, op, key, member, score): `zadd` sets a score and voids what was, `zincrby` adds, `zrem` removes."""
    op = F.when(F.col("op") == "zadd", "set").when(F.col("op") == "zincrby", "incr").when(F.col("op") == "zrem", "del")
    return replay(log.withColumn("op", op).withColumnRenamed("score", "value"), ["key", "member"]).withColumnRenamed("value", "score")


def leaderboard(zset: DataFrame, top: int) -> DataFrame:
    return top_per_key(zset, ["key"], _falling(), top, "rank")


def zrank(zset: DataFrame) -> DataFrame:
    """Zero-based `rank` and `revrank` of every member. Both come from one ordering."""
    placed = row_numbers(zset, ["key"], _rising(), "rank", start=0, total="_size")
    return placed.withColumn("revrank", F.col("_size") - 1 - F.col("rank")).drop("_size")


def zrange(zset: DataFrame, start: int, stop: int, descending: bool = False) -> DataFrame:
    return range_by_index(zset, ["key"], _falling() if descending else _rising(), start, stop)


def zscore(zset: DataFrame, requests: DataFrame) -> DataFrame:
    """Scores of the requested (key, member) pairs, NULL where there is none."""
    return requests.join(_asked(zset, requests, ["key", "member"]), ["key", "member"], "left")


# --- references and stock ----------------------------------------------------------


def follow(references: DataFrame, hashes: DataFrame, on: Column, field: str, name: str) -> DataFrame:
    """Fetch one hash field for the key that `on` gives."""
    wanted = hashes.where(F.col("field") == field).select(F.col("key").alias("_key"), F.col("value").alias(name))
    return references.withColumn("_key", on).join(wanted, "_key").drop("_key")


def allocate(requests: DataFrame, stock: DataFrame, item: str, order: Sequence[Column], quantity: str) -> DataFrame:
    """Accept the first `quantity` requests of each item and reject the others."""
    on_hand = stock.select(item, F.col(quantity).alias("_stock"))
    placed = row_numbers(requests, [item], order, "_place", per_key=on_hand)
    return placed.withColumn("accepted", F.col("_place") <= F.coalesce("_stock", F.lit(0))).drop("_place", "_stock")
