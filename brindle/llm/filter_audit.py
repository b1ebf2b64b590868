"""How five filters act together: what each removes in every order in which they can be applied.

Filters A to D look at a text alone. Filter E, copies, is an existential self-join: a row fails if a row with the same
text has a smaller doc_id. Hashes that occur once are out of question; of the others the distinct texts are written once,
each with its least doc_id, and a left-semi join on hash, exact text and smaller doc_id marks the rows that fail. That
side is summed before it is shuffled, so it holds a group of copies once, and Spark splits hot groups of the other side.

The ids of E are united with what the other filters say about each row, and the bits of a row become one combination.
Combinations are counted for each part; all else follows from those counts, at most 32 for a part: a filter removes what
fails it and none of those before it, and all orders together remove a row by each of its filters equally often.

NULL texts count as empty. A NULL doc_id is neither smaller nor larger than any other and has no labels; rows that repeat a doc_id with
the same text are no copies of each other. NULL parts count as the empty part. Labels that repeat an id count if one of
them does. Empty tables give empty results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.joining import with_findings
from brindle.session import materialize

FILTERS = "ABCDE"
BLANKS = r"[\x20\x09-\x0D]+"
COPY_BIT = 1 << FILTERS.index("E")


def failures(text: Column) -> Column:
    """The bits of A to D: under 50 words, few distinct words, many capitals, symbols."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [
        n < 50,
        100 * F.size(F.array_distinct(words)) < 65 * n,
        100 * capitals > 5 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails)), F.lit(0))


def copies(docs: DataFrame) -> DataFrame:
    """doc_id and text_key of the rows whose exact text a row with a smaller doc_id has too; once each."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"))
    seen = rows.groupBy("text_key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    twice = materialize(seen.where((F.col("n") > 1) & (F.col("least") < F.col("most"))).select("text_key"), "twice")
    again = with_findings(rows, twice, "text_key")
    firsts = materialize(again.groupBy("text_key", "text").agg(F.min("doc_id").alias("least")), "firsts")
    left, right = again.alias("l"), firsts.alias("r")
    earlier = (F.col("l.text_key") == F.col("r.text_key")) & (F.col("l.text") == F.col("r.text")) & (F.col("r.least") < F.col("l.doc_id"))
    return left.join(right, earlier, "left_semi").select("doc_id", "text_key").distinct()


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask of failed filters, and counts: n, those labelled good, those labelled toxic. One row for each that occurs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = (
        docs.select("doc_id", F.xxhash64(text).alias("text_key"), F.coalesce(F.col("source"), F.lit("")).alias("part"), failures(text).alias("mask"))
        .groupBy("doc_id", "text_key", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    )
    marked = copies(docs).select(
        "doc_id", "text_key", F.lit(None).cast("string").alias("part"), F.lit(COPY_BIT).alias("mask"), F.lit(0).cast("bigint").alias("n")
    )
    # A row's parts are as many as sources repeat its id with the same text, so the lists are short.
    bits = own.unionByName(marked).groupBy("doc_id", "text_key").agg(
        F.bit_or("mask").alias("mask"), F.collect_list(F.when(F.col("n") > 0, F.struct("part", "n"))).alias("parts")
    )
    counted = bits.select("doc_id", "mask", F.inline("parts")).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    known = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return counted.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(F.lit(0))).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(F.lit(0))).alias("toxic"),
    )


def _steps() -> list[dict]:
    """Every step of every order: its filter's bit and the bits of those before it."""
    out = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append({"filter_order": order, "step": step, "bit": bit, "before": before})
            before |= bit
    return out


def _total(what: str, condition: str, weight: str = "1") -> Column:
    return F.expr(f"aggregate(counts, 0L, (s, c) -> s + if({condition}, c.{what} * {weight}, 0L))")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    parts = combinations(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    steps = F.from_json(F.lit(json.dumps(_steps())), "array<struct<filter_order: string, step: int, bit: int, before: int>>")
    fails, before = "(c.mask & bit) != 0", "(c.mask & before) != 0"
    removed = f"{fails} AND NOT {before}"
    return parts.select("part", "counts", F.inline(steps)).select(
        "part", "filter_order", "step",
        _total("n", "(c.mask & (before | bit)) = 0").alias("kept"),
        _total("n", removed).alias("removed"),
        _total("n", f"{fails} AND {before}").alias("redundant"),
        _total("n", "c.mask = bit").alias("unique_fails"),
        _total("good", removed).alias("good_lost"),
        _total("toxic", removed).alias("toxic_lost"),
        # Of the orders, each filter that a row fails is the first of those in the same number.
        _total("n", fails, "(120 div bit_count(c.mask))").alias("shapley"),
    )
