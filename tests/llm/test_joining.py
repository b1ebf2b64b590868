"""Joins of texts with findings, whatever the bitmap holds."""

import pytest

from brindle.llm import joining
from tests.llm import plain


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_joins_are_exact_for_any_bitmap(spark, monkeypatch, bits):
    monkeypatch.setattr(joining, "BITS", bits)
    docs = plain.documents(spark, [(k, f"t{k}") for k in range(200)] + [(None, "n"), (5, "t5")])
    found = spark.createDataFrame([(5, "a"), (5, "b"), (150, "c"), (999, "d"), (None, "e")], "doc_id bigint, what string")
    pairs = joining.with_findings(docs, found, "doc_id").select("doc_id", "what").collect()
    assert sorted(map(tuple, pairs), key=str) == sorted([(5, "a"), (5, "b"), (5, "a"), (5, "b"), (150, "c"), (None, "e")], key=str)
    left = joining.with_findings_or_none(docs, found, "doc_id")
    assert left.count() == 202 + 2 and left.where("what IS NULL").count() == 198
    rest = joining.without_findings(docs, found, "doc_id")
    assert rest.columns == docs.columns
    assert sorted(r.doc_id for r in rest.collect()) == [k for k in range(200) if k not in (5, 150)]


def test_no_findings(spark):
    docs = plain.documents(spark, [(1, "a"), (None, None)])
    none = spark.createDataFrame([], "doc_id bigint, text_key bigint")
    assert joining.with_findings(docs, none, "doc_id").count() == 0
    assert joining.without_findings(docs, none, "doc_id").count() == 2


def test_packed_rows_come_back_whole(spark):
    docs = plain.documents(spark, [(1, "a"), (2, None)])
    back = joining.packed(docs).select("row.*")
    assert back.schema == docs.schema and sorted(map(tuple, back.collect())) == sorted(map(tuple, docs.collect()))
