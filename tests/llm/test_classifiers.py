"""Held-out accuracy of the trained models, and what they do without labels or texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import quality, queries, toxicity
from brindle.llm.training import held_out, labelled_sample
from brindle.llm.words import split
from tests.llm import plain

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name, label, least", [("op2_toxicity", "toxic", 0.9), ("op6_quality", "quality", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    got = queries.QUERIES[name](spark, FOLDER)
    known = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = got.join(known, "doc_id").where("held_out").select(label, "predicted", "score").collect()
    per_class = [np.mean([r.predicted == value for r in rows if r[0] == value]) for value in (0, 1)]
    assert np.mean(per_class) >= least
    assert all(0 <= r.score <= 1 for r in rows)
    assert got.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    wrong = got.where((F.col("predicted") == 1) != (F.col("score") >= (0.7 if label == "toxic" else 0.3)))
    assert wrong.isEmpty()


ODD = [(1, None), (2, ""), (3, "!!!"), (None, "a b"), (None, "a b"), (4, "word " * 30_000)]


@pytest.mark.parametrize("module, at", [(toxicity, 0.7), (quality, 0.3)])
def test_without_labels(spark, module, at):
    docs = plain.documents(spark, ODD)
    none = spark.createDataFrame([], "doc_id bigint, mark int")
    got = module.scores(docs, none, "mark", 5, 0, at).collect()
    assert len(got) == len(ODD) and len({r.score for r in got}) == 1
    one = spark.createDataFrame([(1, 1), (2, None), (3, 1), (None, 0)], "doc_id bigint, mark int")
    assert module.scores(docs, one, "mark", 5, 0, at).count() == len(ODD)
    assert module.scores(docs.limit(0), one, "mark", 5, 0, at).count() == 0


@pytest.mark.parametrize("module, at", [(toxicity, 0.7), (quality, 0.3)])
def test_odd_texts_are_scored(spark, module, at):
    good, bad = "the quick word of it. ", "VILE!! ### VILE!! "
    rows = [(k, (bad if k % 2 else good) * (1 + k % 5) + str(k)) for k in range(10, 130)] + ODD
    marks = spark.createDataFrame([(k, k % 2) for k in range(10, 130)] + [(11, 0), (4, None)], "doc_id bigint, mark int")
    docs = plain.documents(spark, rows)
    got = module.scores(docs, marks, "mark", 5, 0, at).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id and r.doc_id > 10)
    again = {(r.doc_id, round(r.score, 6)) for r in module.scores(docs.repartition(3), marks, "mark", 5, 0, at).collect()}
    assert again == {(r.doc_id, round(r.score, 6)) for r in got}


def test_kept_rows_have_their_columns(spark):
    rows = [(k, ("bad!! ### " if k % 2 else "good words of it. ") * 5 + str(k)) for k in range(10, 130)]
    marks = spark.createDataFrame([(k, 1 - k % 2) for k in range(10, 130)], "doc_id bigint, mark int")
    docs = plain.documents(spark, rows)
    kept = quality.keep_good(docs, marks, "mark", 5, 0, 0.3)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(10, 130, 2))


def test_a_long_text_does_not_end_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_WORDS", 5_000)
    ids = spark.range(10, 130).where(~held_out("id", 5, 0))
    first = ids.orderBy(F.xxhash64("id")).first()[0]  # the sample is read in this order
    good, bad = "the quick word of it. ", "VILE!! ### VILE!! "
    rows = [(k, (bad if k % 2 else good) * (20_000 if k == first else 3) + str(k)) for k in range(10, 130)]
    marks = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id bigint, mark int")
    got = toxicity.scores(plain.documents(spark, rows), marks, "mark", 5, 0, 0.7).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got) and len(got) == len(rows)


def test_held_out_is_by_crc(spark):
    import zlib

    ids = spark.createDataFrame([(k,) for k in range(50)] + [(None,)], "doc_id bigint")
    got = ids.select("doc_id", held_out("doc_id", 5, 0).alias("h")).collect()
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_pairs_order_documents():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    weights = quality.learn_pairs(x[:200] + [2, 0, 0], x[200:])
    assert weights[0] > 4 * np.abs(weights[1:]).max()


def test_pairs_are_summed_in_parts(monkeypatch):
    rng = np.random.default_rng(2)
    x, good = rng.normal(size=(3000, 4)), np.arange(3000) % 2 == 0
    x[good] += [1, 0, 0.5, 0]
    held = []
    monkeypatch.setattr(quality, "AT_A_TIME", 1000)
    clip = np.clip
    monkeypatch.setattr(quality.np, "clip", lambda a, *b: held.append(len(a)) or clip(a, *b))
    parts = quality.fit(x, good, 0.3)
    pairs = 20 * len(x)
    assert max(held) == 1000 and len(held) % (pairs // 1000) == 0
    monkeypatch.setattr(quality, "AT_A_TIME", pairs)
    assert np.allclose(parts.weights, quality.fit(x, good, 0.3).weights, rtol=1e-9)


def test_languages_by_function_words():
    texts = ["the cat of it is", "der Hund und das", "le chat et les", "el gato y los", None, "xyz"]
    assert [toxicity.LANGUAGES[k] for k in toxicity.languages(split(texts))] == ["en", "de", "fr", "es", "other", "other"]


def test_a_labelled_id_enters_the_sample_once_however_often_it_occurs(spark):
    docs = spark.range(30_000).selectExpr("id % 2 AS doc_id", "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 3 = 1 THEN NULL ELSE concat('t', id % 7) END AS text")
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, 0)], "doc_id long, quality int")
    sample = labelled_sample(docs, labels, "quality", 5, 9, per_class=100)
    assert sorted((r.doc_id, r.label) for r in sample.collect()) == [(0, 1), (1, 0)]
    again = labelled_sample(docs.repartition(7), labels, "quality", 5, 9, per_class=100)
    assert sorted(sample.collect(), key=str) == sorted(again.collect(), key=str)


def test_every_labelled_document_is_learned_from(spark, monkeypatch):
    """More documents of a class than any sample held, and few of the other; as many blocks as it takes."""
    docs = spark.range(26_000).selectExpr("id AS doc_id", "concat(CASE WHEN id % 100 = 0 THEN 'bad!! ### ' ELSE 'good words of it. ' END, id % 7) AS text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 100 <> 0 AS INT) AS mark")
    rows = quality.learning_rows(docs, labels, "mark", 5, 0)
    wanted = docs.where(~held_out("doc_id", 5, 0)).count()
    assert rows.count() == wanted > 20_000
    monkeypatch.setattr(quality, "BLOCK", 3_000)
    got = quality.scores(docs, labels, "mark", 5, 0, 0.3)
    assert got.where((F.col("predicted") == 1) != (F.col("doc_id") % 100 != 0)).isEmpty()


def test_blocks_hold_every_document(spark, monkeypatch):
    """Those of the larger class once, those of the smaller one as often as it takes."""
    width = quality.WIDTH
    rows = spark.range(500).selectExpr("id AS doc_id", "CAST(id % 50 = 0 AS INT) AS label", f"array_repeat(CAST(id AS DOUBLE), {width}) AS x")
    monkeypatch.setattr(quality, "BLOCK", 100)
    monkeypatch.setattr(quality, "LEAST", 8)
    blocks = [[np.frombuffer(r[k]).reshape(-1, width)[:, 0] for k in ("good", "bad")]
              for r in quality._blocked(rows, 10, 490, np.zeros(width), np.ones(width)).collect()]
    assert len(blocks) == 5 and all(len(good) and len(bad) for good, bad in blocks)
    assert sorted(np.concatenate([bad for _, bad in blocks])) == [k for k in range(500) if k % 50]
    assert sorted(set(np.concatenate([good for good, _ in blocks]))) == list(range(0, 500, 50))


def test_every_row_is_in_pairs():
    first, second = quality._pairs(700, 30, 1)
    assert len(first) == len(second) == 20 * 730
    assert np.bincount(first, minlength=700).min() >= 20 and np.bincount(second, minlength=30).min() >= 20


def test_the_cut_is_that_of_all_scores(spark):
    rng = np.random.default_rng(4)
    good = rng.random(3000) < 0.3
    scores = rng.normal(size=3000) + 1.5 * good
    scored = spark.createDataFrame([(int(g), float(s)) for g, s in zip(good, scores)], "label int, score double").repartition(5)
    assert quality._best_cut(scored, int(good.sum()), int((~good).sum())) == pytest.approx(quality.best_quantile(scores, good))
    same = spark.createDataFrame([(1, 0.5), (0, 0.5)], "label int, score double")
    assert quality._best_cut(same, 1, 1) == 0.5
