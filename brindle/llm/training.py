"""Labelled documents for the classifiers to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GRAIN = 1_000_000


def held_out(doc_id: str, modulus: int, keep_out: int) -> Column:
    """Whether a row is kept out of learning; a NULL id is not held out, and never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(modulus)) == keep_out, F.lit(False))


def learning_labels(labels: DataFrame, label: str, modulus: int, keep_out: int) -> DataFrame:
    """doc_id and `label` (0 or 1) of what may be learned from: no held-out ids, none with two different labels, no NULL."""
    return (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", modulus, keep_out))
        .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("_other"))
        .where(F.col("label") == F.col("_other")).select("doc_id", "label")
    )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, keep_out: int, per_class: int
) -> DataFrame:
    """Texts with `label` 0 or 1, about `per_class` of each, never held-out ones.

    Ids are picked by a hash, so the sample repeats, and its expected size does not grow with the tables. Documents
    with two different labels, and NULL ids or labels, are left out. The ids are broadcast, which the bound allows.
    However often rows repeat an id, one text enters for it: the one with the least hash.
    """
    clean = learning_labels(labels, label, modulus, keep_out)
    sizes = {r["label"]: r["count"] for r in clean.groupBy("label").count().collect()}
    share = F.lit(0)
    for value, n in sizes.items():
        share = F.when(F.col("label") == value, min(_GRAIN, max(1, _GRAIN * per_class // n))).otherwise(share)
    picked = clean.where(F.pmod(F.xxhash64("doc_id"), F.lit(_GRAIN)) < share)
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("_key"), "text")).alias("_one")
    return found.groupBy("doc_id", "label").agg(one).select("doc_id", "_one.text", "label")
