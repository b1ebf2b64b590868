"""Random choices that repeat for the same seed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.hashing import pick, stable_hash
from brindle.functions.text import capitalise
from brindle.operators.ordering import row_numbers
from brindle.session import materialize


def random_rows(df: DataFrame, identity: str, count: int, seed: int) -> DataFrame:
    """`count` rows without replacement. Each task keeps only its best `count`."""
    return df.orderBy(stable_hash(F.col(identity), F.lit(seed)), identity).limit(count)


def numbered_words(words: DataFrame) -> DataFrame:
    """(position, word): the distinct words of column `word` in order, from 0."""
    return row_numbers(words.where(F.col("word").isNotNull()).distinct(), [], [F.col("word")], "position", start=0)


def sentences(rows: DataFrame, identity: str, adjectives: DataFrame, nouns: DataFrame, verbs: DataFrame) -> DataFrame:
    """A sentence per row: adjective noun verb adjective noun, picked per slot, first letter upper-case.

    Words come from tables of any size; each slot is a join by position.
    """
    tables = {name: materialize(numbered_words(df), "words") for name, df in (("adjective", adjectives), ("noun", nouns), ("verb", verbs))}
    counts = {name: df.count() for name, df in tables.items()}
    out = rows
    slots = [("adjective", "1"), ("noun", "1"), ("verb", ""), ("adjective", "2"), ("noun", "2")]
    for kind, which in slots:
        at = pick(max(1, counts[kind]), F.col(identity), F.lit(kind + which)).cast("bigint")
        words = tables[kind].select(F.col("position").alias("_at"), F.col("word").alias(f"_{kind}{which}"))
        out = out.withColumn("_at", at).join(words, "_at", "left").drop("_at")
    text = F.concat_ws(" ", *[F.col(f"_{kind}{which}") for kind, which in slots])
    return out.withColumn("sentence", capitalise(text)).drop(*[f"_{kind}{which}" for kind, which in slots])
