"""Exact duplicates with frequent digests split off.

Texts are equal when identical after A-Z are lower-cased. Misra-Gries summaries, one per task, find the digests that
hold a large share of the rows. Their exact winners are few, by proof, and are broadcast: rows of a frequent digest
are decided where they lie. Only the other digests are shuffled, and none of those can be large.

NULL counts as the empty text. Of equal texts the row with the largest doc_id stays (NULL is the smallest); of rows
that repeat that doc_id too, one stays. Empty tables give empty results. Other columns are carried along or ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import nlargest

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm.joining import packed
from brindle.llm.words import LOWER, field
from brindle.session import materialize, scratch_of_its_own

COUNTERS = 4096  # counters of a summary; at most so many digests, and one more, count as frequent


def _digest(text: bytes | None) -> bytes:
    return hashlib.sha256((text or b"").translate(LOWER)).digest()


def _with_digest(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digest = pa.array([_digest(t) for t in field(batch, path).cast(pa.binary()).to_pylist()], pa.binary())
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), digest], names=[*names, "_digest"])


def with_digest(rows: DataFrame, path: str = "text") -> DataFrame:
    """The columns but `text`, and `_digest`, the SHA-256 of the lower-cased text at `path`."""
    columns = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*columns, T.StructField("_digest", T.BinaryType())])
    return rows.mapInArrow(lambda batches: _with_digest(batches, path), schema)


def _reduce(counts: dict[bytes, int], size: int) -> dict[bytes, int]:
    """Misra-Gries: keep at most `size` counters, taking the next largest count off all of them."""
    if len(counts) <= size:
        return counts
    off = nlargest(size + 1, counts.values())[-1]
    return {k: n - off for k, n in counts.items() if n > off}


def _summary(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    counts: dict[bytes, int] = {}
    for batch in batches:
        for digest in batch.column("_digest").to_pylist():
            counts[digest] = counts.get(digest, 0) + 1
            if len(counts) >= 4 * size:
                counts = _reduce(counts, size)
    counts = _reduce(counts, size)
    keys = pa.array(list(counts), pa.binary())
    yield pa.RecordBatch.from_arrays([keys, pa.array(list(counts.values()), pa.int64())], names=["_digest", "seen"])


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests that may be frequent: all with more than 2 rows in `counters` are among them, and it never gives more
    than `counters` + 1.

    A task's summary counts a digest too low by at most its rows / (counters + 1). The sums are therefore too low by
    at most n / (counters + 1), and they add up to no more than n, the number of rows.
    """
    total = digests.count()
    summed = (
        digests.select("_digest")
        .mapInArrow(lambda batches: _summary(batches, counters), "_digest binary, seen bigint")
        .groupBy("_digest").agg(F.sum("seen").alias("seen"))
    )
    return summed.where((F.col("seen") >= max(2.0, total / (counters + 1)))).select("_digest")


def _winners(digests: DataFrame, counters: int) -> DataFrame:
    """Exact size and winner of the frequent digests, at most `counters` + 1 rows."""
    few = F.broadcast(materialize(frequent(digests, counters), "frequent"))
    exact = digests.join(few, "_digest").groupBy("_digest").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "_row")).alias("best")
    )
    return materialize(exact, "winners")


def _narrow(docs: DataFrame) -> DataFrame:
    narrow = with_digest(docs.select("doc_id", "text"))
    return materialize(narrow.withColumn("_row", F.monotonically_increasing_id()), "digests")


def decide(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document, in the end kept or not: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = _narrow(docs)
    known = F.broadcast(_winners(digests, counters))
    heavy = digests.join(known, "_digest")
    group = Window.partitionBy("_digest")
    rest = (
        digests.join(known, "_digest", "left_anti")
        .withColumn("group_size", F.count(F.lit(1)).over(group))
        .withColumn("best", F.max(F.struct("doc_id", "_row")).over(group))
    )
    both = heavy.unionByName(rest)
    return both.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("best._row")).alias("kept"), F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of `docs` that stay, with their columns.

    Copies of a frequent text go where they lie; only its winner and the texts that are not frequent are shuffled.
    """
    with scratch_of_its_own(docs.sparkSession) as keep:
        best = keep(_winners(_narrow(docs), counters).select("_digest", F.col("best.doc_id").alias("_best")), "best")
    left = (
        with_digest(packed(docs).select("row"), "row.text").join(F.broadcast(best), "_digest", "left")
        .where(F.col("_best").isNull() | F.col("row.doc_id").eqNullSafe(F.col("_best")))
    )
    place = F.row_number().over(Window.partitionBy("_digest").orderBy(F.col("row.doc_id").desc_nulls_last()))
    return left.withColumn("_place", place).where(F.col("_place") == 1).select("row.*")
