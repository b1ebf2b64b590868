"""The registered queries against SQL, and the pipeline against plain versions of its stages."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from brindle.llm import decontamination, mixing, ngram_join, quality, queries
from tests.compare import connect, spark_rows, sql_rows
from tests.llm import plain

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, FOLDER)) == sql_rows(connect(FOLDER), queries.SQL[name])


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_join_and_decontamination_on_the_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = queries.QUERIES["op9_ngram_join"](spark, FOLDER)
    assert sorted(map(tuple, got.collect())) == sorted(plain.similar(rows))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = {n: spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("labels", "benchmark")}
    model = quality.train(docs, tables["labels"], "quality", 5, 0, 0.3)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    keep = model.score(quality.features([(t or "").encode() for _, t in rows])) >= 0.3
    rows = [r for r, k in zip(rows, keep) if k]
    rows = list({(t or "").translate(plain.LOWER): (d, t) for d, t in sorted(rows)}.values())
    groups = {d: g for d, *_, g in plain.similar(rows)}
    rows = [(d, t) for d, t in rows if groups[d] == d]
    bench = [(r.item_id, r.text) for r in tables["benchmark"].collect()]
    rows = [r for r, c in zip(rows, plain.contaminated(rows, bench)) if not c[-1]]
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, stage(spark, left, FOLDER).cache()
        assert left.columns == before.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, _ in rows)
    out = corpus_pipeline.run(spark, FOLDER)
    assert set(out.columns) == {*docs.columns, "rate", "copies"}
    known = queries.domains(left, tables["labels"])
    rates = mixing.rates(left, known, queries.TARGETS).where("copies > 0")
    assert sorted((r.doc_id, r.copies) for r in out.collect()) == sorted((r.doc_id, r.copies) for r in rates.collect())


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert ngram_join.similar(spark.read.parquet(f"{tmp_path}/documents.parquet")).count() == 0
    assert decontamination.contamination(*(spark.read.parquet(f"{tmp_path}/{n}.parquet") for n in ("documents", "benchmark"))).count() == 0
