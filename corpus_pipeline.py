"""From raw documents to a training mixture, in five stages, each written as Parquet and read by the next one.

run(spark, sf_dir) gives the mixed documents. All stages but the last return the columns of `documents`; the last one
adds `rate` and `copies`, how often a document is to be taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brindle.llm import decontamination, exact_dedup, mixing, ngram_join, quality
from brindle.llm.queries import TARGETS, domains
from brindle.session import fresh_path, scratch_of_its_own, tune


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"), "quality", modulus=5, keep_out=0, at=0.3)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    tune(spark)
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of similar texts the document with the least id stays."""
    tune(spark)
    return ngram_join.keep_one(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more stands in benchmark items go."""
    return decontamination.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn at rates by which the languages have their target parts of the tokens; others keep theirs."""
    return mixing.mixture(docs, domains(docs, _table(spark, sf_dir, "labels")), TARGETS, keep_others=True)


STAGES = [
    ("quality classifier", good_quality), ("exact dedup", without_copies), ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmarks), ("mixing to target weights", mixed),
]

#: Trained scores and rates are not for SQL; the tests hold run() against the stages' plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage writes on its way is cleared when its result is written."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = fresh_path(spark, "stage")
        with scratch_of_its_own(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
