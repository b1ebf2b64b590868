"""Replay of a whole command log: texts, numbers, hashes, sets, sorted sets, lists, and keys that change their name.

A log has the columns seq, op, key, item, value. `seq` tells commands apart.

| op | item, value |
| --- | --- |
| `set` | value: any text; what the key held before is gone |
| `incr` | value: a number to add; a key without a value counts from 0, a text that is no number stays as it is |
| `hset`, `hdel` | item: the field |
| `sadd`, `srem` | item: the member |
| `zadd`, `zincrby`, `zrem` | item: the member; value: its score, or what to add to it |
| `lpush`, `rpush`, `lpop`, `rpop` | item: what is pushed |
| `del` | all that the key held is gone |
| `rename` | item: the new name; all that it held is gone. Without such a key, or to the same name, nothing happens |

A key exists from the first command that writes to it until it is deleted or renamed; one whose parts were all taken out
still does. Hashes, sets, sorted sets, lists and the text of a key are told apart, so no command meets a wrong kind. Any
other command is an error. Numbers are added exactly, with up to 12 digits after the point, and printed without zeros
at the end.

Deleting and renaming cut a key's time into spans. A span that ends with a rename goes on in the span that it opens under
the new name, so every command belongs to the span its own ends in, and each chain of spans is one object. Chains are
found among spans alone, by doubling; the log itself is numbered once, and only for keys that are deleted or renamed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.operators import queues
from brindle.operators.ordering import SLAB, in_slabs, running_total
from brindle.session import materialize

WRITES = ("set", "incr", "hset", "sadd", "zadd", "zincrby", "lpush", "rpush")
TAKES = ("hdel", "srem", "zrem", "lpop", "rpop")
NUMBER = "decimal(37,12)"  # two of them add up without losing a digit
NUMERIC = r"^[+-]?([0-9]{1,25})([.][0-9]{1,12})?$"


def _op(*names: str) -> Column:
    return F.col("op").isin(*names)


def number_text(number: Column) -> Column:
    """A decimal as text without zeros at its end."""
    text = number.cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"([.][0-9]*?)0+$", "$1"), r"[.]$", "")


def as_number(text: Column) -> Column:
    """The exact number that a text is, NULL if it is none of at most 25 and 12 digits."""
    return F.when(F.trim(text).rlike(NUMERIC), F.trim(text)).cast(NUMBER)


def _checked(log: DataFrame) -> DataFrame:
    wrong = F.concat(F.lit("no such command: "), F.coalesce("op", F.lit("NULL")))
    op = F.when(_op(*WRITES, *TAKES, "del", "rename"), F.col("op")).otherwise(F.raise_error(wrong))
    return log.select("seq", op.alias("op"), "key", "item", "value").where(~((F.col("op") == "rename") & F.col("key").eqNullSafe(F.col("item"))))


# --- objects -----------------------------------------------------------------------


def _cuts(log: DataFrame) -> DataFrame:
    """What ends a span of a key and opens the next: `del`, a rename away from it (`out`) or to it (`in`)."""
    renames = log.where(_op("rename"))
    gone = log.where(_op("del")).select("seq", "key", F.lit("del").alias("cut"))
    out = renames.select("seq", "key", F.lit("out").alias("cut"))
    return gone.unionByName(out).unionByName(renames.select("seq", F.col("item").alias("key"), F.lit("in").alias("cut")))


def _existing(opened: DataFrame, renamed: DataFrame, written: DataFrame) -> DataFrame:
    """Spans (key, span) at whose end the key exists.

    Something was written in them, or a rename opened them and its source existed or the key did before. Each round
    doubles the steps, so that spans are reached in as many rounds as the longest way has binary digits, at most; it is
    over once a round reaches no further span.
    """
    arrivals = opened.where("cut = 'in'")
    from_source = renamed.join(arrivals.select("seq", F.col("key").alias("to_key"), F.col("span").alias("to_span")), "seq").select("key", "span", "to_key", "to_span")
    from_before = arrivals.select("key", (F.col("span") - 1).alias("span"), F.col("key").alias("to_key"), F.col("span").alias("to_span"))
    steps = materialize(from_source.unionByName(from_before), "steps")
    reached = materialize(written.join(steps.select("key", "span"), ["key", "span"], "left_semi"), "reached")
    count, before = reached.count(), -1
    while count > before:
        landed = steps.join(reached, ["key", "span"], "left_semi").select(F.col("to_key").alias("key"), F.col("to_span").alias("span"))
        reached = materialize(reached.unionByName(landed).distinct(), "reached")
        count, before = reached.count(), count
        if count > before:
            ahead = steps.select(F.col("key").alias("to_key"), F.col("span").alias("to_span"), F.col("to_key").alias("far_key"), F.col("to_span").alias("far_span"))
            farther = steps.join(ahead, ["to_key", "to_span"])
            steps = materialize(farther.select("key", "span", F.col("far_key").alias("to_key"), F.col("far_span").alias("to_span")).distinct(), "steps")
    return written.unionByName(reached)


def _chains(follows: DataFrame) -> DataFrame:
    """Where each span's chain ends: (key, span, to_key, to_span), by doubling the steps."""
    hops = materialize(follows, "hops")
    while True:
        ahead = hops.select(F.col("key").alias("to_key"), F.col("span").alias("to_span"), F.col("to_key").alias("far_key"), F.col("to_span").alias("far_span"))
        farther = hops.join(ahead, ["to_key", "to_span"], "left")
        moved = materialize(farther.select(
            "key", "span", F.coalesce("far_key", "to_key").alias("to_key"), F.coalesce("far_span", "to_span").alias("to_span"),
            F.col("far_key").isNotNull().alias("_moved"),
        ), "hops")
        hops = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return hops


def _renamed(spans: DataFrame, ended: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The spans (name, object) that end for good, and where the chain of each span that goes on ends."""
    opened = ended.withColumn("span", F.col("span") + 1)
    renamed = ended.where("cut = 'out'").select("seq", "key", "span")
    written = materialize(spans.where(_op(*WRITES)).select("key", "span").distinct(), "written")
    done = renamed.join(_existing(opened, renamed, written), ["key", "span"], "left_semi").select("seq", F.lit(True).alias("_done"))

    # A rename that was done leads on under the new name and ends what was there; one that was not cuts nothing.
    fate = ended.join(done, "seq", "left").withColumn("_done", F.coalesce("_done", F.lit(False)))
    target = opened.where("cut = 'in'").select("seq", F.col("key").alias("to_key"), F.col("span").alias("to_span"))
    leads = fate.where("cut = 'out' AND _done").join(target, "seq").select("key", "span", "to_key", "to_span")
    goes_on = fate.where("cut <> 'del' AND NOT _done").select("key", "span", F.col("key").alias("to_key"), (F.col("span") + 1).alias("to_span"))
    dead = fate.where("cut = 'del' OR (cut = 'in' AND _done)").select(F.col("key").alias("name"), F.col("span").alias("object"))
    return dead, _chains(leads.unionByName(goes_on))


def with_objects(log: DataFrame) -> DataFrame:
    """The commands on contents with `name`, `object` and `alive`: the object they act on, the name it has in the end,
    and whether it is there then. Commands on a key NULL are left out."""
    log = _checked(log).where(F.col("key").isNotNull() & (~_op("rename") | F.col("item").isNotNull()))
    contents = log.where(_op(*WRITES, *TAKES))
    cuts = materialize(_cuts(log), "cuts")
    plain = {"name": F.col("key"), "object": F.lit(0).cast("bigint"), "alive": F.lit(True)}
    if cuts.isEmpty():
        return contents.withColumns(plain)
    cut_keys = cuts.select("key").distinct()
    uncut = contents.join(cut_keys, "key", "left_anti").withColumns(plain)

    both = contents.join(cut_keys, "key", "left_semi").withColumn("cut", F.lit(None).cast("string")).unionByName(cuts, allowMissingColumns=True)
    is_cut = F.when(F.col("cut").isNotNull(), 1).otherwise(0).cast("bigint")
    spans = materialize(running_total(both, ["key"], [F.col("seq")], is_cut, "span"), "spans")
    ended = spans.where(F.col("cut").isNotNull()).select("seq", "key", "cut", "span")
    contents = spans.where(F.col("cut").isNull()).drop("cut")
    if ended.where("cut = 'out'").isEmpty():
        dead, ends = ended.select(F.col("key").alias("name"), F.col("span").alias("object")), None
    else:
        dead, ends = _renamed(spans, ended)
        contents = contents.join(ends, ["key", "span"], "left")
    named = {"name": F.col("key"), "object": F.col("span")} if ends is None else {"name": F.coalesce("to_key", "key"), "object": F.coalesce("to_span", "span")}
    resolved = contents.withColumns(named).drop("to_key", "to_span", "span")
    resolved = resolved.join(dead.withColumn("alive", F.lit(False)), ["name", "object"], "left").withColumn("alive", F.coalesce("alive", F.lit(True)))
    return uncut.unionByName(resolved)


# --- contents ----------------------------------------------------------------------


def texts(log: DataFrame, on: list[str]) -> DataFrame:
    """Final texts of `set`, `incr` and `del`: the last `set` or `del` is the base, and what is added after it counts.

    The log is cut into slabs by key and time, so a hot key is spread over many tasks.
    """
    rows = log.where(_op("set", "incr", "del")).withColumn("_number", as_number(F.col("value")))
    slabs, by = in_slabs(rows, on, [F.col("seq")])
    base = F.max(F.when(_op("set", "del"), F.col("seq"))).over(Window.partitionBy(*by, SLAB))
    current = slabs.withColumn("_base", base).where(F.col("_base").isNull() | (F.col("seq") >= F.col("_base")))
    parts = current.groupBy(*by, SLAB).agg(
        F.max(F.when(_op("set", "del"), F.struct("op", "value"))).alias("_base"),
        F.sum(F.when(_op("incr"), F.col("_number"))).alias("_added"), F.max(_op("incr")).alias("_adds"),
    )
    first = F.max(F.when(F.col("_base").isNotNull(), F.col(SLAB))).over(Window.partitionBy(*by))
    valid = parts.withColumn("_first", first).where(F.col("_first").isNull() | (F.col(SLAB) >= F.col("_first")))
    totals = valid.groupBy(*by).agg(F.max("_base").alias("_base"), F.sum("_added").alias("_added"), F.max("_adds").alias("_adds"))
    text = F.when(F.col("_base.op") == "set", F.col("_base.value"))
    start = F.when(F.col("_base.op") == "set", as_number(text)).otherwise(F.lit(0).cast(NUMBER))
    value = F.when(~F.col("_adds") | start.isNull(), text).otherwise(number_text(start + F.coalesce(F.col("_added").cast(NUMBER), F.lit(0).cast(NUMBER))))
    there = totals.where(F.col("_adds") | (F.col("_base.op") == "set"))
    return there.select(*(on if by == on else [f"{by[0]}.*"]), value.alias("value"))


def _last(rows: DataFrame, put: str, drop: str) -> DataFrame:
    newest = rows.where(_op(put, drop)).groupBy("name", "item").agg(F.max_by(F.struct("op", "value"), "seq").alias("_now"))
    return newest.where(F.col("_now.op") == put).select("name", "item", F.col("_now.value").alias("value"))


def replay(log: DataFrame) -> DataFrame:
    """What all keys hold in the end: key, kind, item, pos (of list items), value; numbers as text."""
    rows = materialize(with_objects(log).where("alive").drop("alive", "object", "key"), "objects")
    others = rows.where(~_op("set", "incr"))
    if not rows.where(_op("set")).isEmpty():
        reset = materialize(rows.where(_op("set")).groupBy("name").agg(F.max("seq").alias("_set")), "reset")
        others = others.join(reset, "name", "left").where(F.col("_set").isNull() | (F.col("seq") > F.col("_set"))).drop("_set")
    scores = {"zadd": "set", "zincrby": "incr", "zrem": "del"}
    scored = others.where(_op(*scores)).replace(scores, subset=["op"])
    lists = queues.remaining(queues.placed(others.where(_op(*queues.PUSHES, *queues.POPS)).drop("value"), ["name"]))
    nothing = F.lit(None).cast("string")
    kinds = {
        "string": texts(rows, ["name"]).withColumn("item", nothing),
        "hash": _last(others, "hset", "hdel"), "set": _last(others, "sadd", "srem").withColumn("value", nothing),
        "zset": texts(scored, ["name", "item"]), "list": lists.withColumn("value", nothing),
    }
    parts = [
        df.select(F.col("name").alias("key"), F.lit(kind).alias("kind"), "item", (F.col("pos") if kind == "list" else F.lit(None)).cast("bigint").alias("pos"), "value")
        for kind, df in kinds.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def pops(log: DataFrame) -> DataFrame:
    """What each `lpop` and `rpop` takes, NULL from an empty list: seq, op, key (the name used), item.

    An object that is deleted, overwritten or set to a text begins a new list.
    """
    rows = materialize(with_objects(log).where(_op("set", *queues.PUSHES, *queues.POPS)), "objects")
    sets = rows.where(_op("set")).withColumn("op", F.lit(queues.CLEAR))
    commands = rows.where(_op(*queues.PUSHES, *queues.POPS)).unionByName(sets)
    tape = queues.placed(commands.select("seq", "op", "name", "object", "item"), ["name", "object"])
    names = rows.where(_op(*queues.POPS)).select("seq", "key")
    return queues.taken(tape).drop("name", "object").join(names, "seq").select("seq", "op", "key", "item")
