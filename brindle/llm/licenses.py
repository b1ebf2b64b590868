"""License scans by diagonal voting.

All rolling word k-grams of the documents are hashed and joined with the k-grams of license templates. Each match votes
for the diagonal "place in the document minus place in the template"; votes are added up per document, template and
diagonal. Diagonals that lie next to each other, as after an inserted or missing word, are merged to one span, and
each span with enough votes is compared word by word with its template. Of spans that overlap, those most like their
templates stay.

Base phrases are found apart from that, at every place where their words stand one after the other. A base label is
never taken away; the templates add labels of their own.

NULL counts as the empty text: no words, no labels, score 0. Repeated rows are scanned each; a row is told by its id,
NULL included, and a hash of its text. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.llm.joining import with_findings
from brindle.llm.words import Words, signed, slices, split, windows
from brindle.session import materialize

K = 3  # words of a k-gram
DRIFT = 3  # diagonals this far apart, or less, are neighbours
VOTES = 0.4  # share of a template's k-grams that a span needs to be looked at
LIKE = 0.8  # share of a template's words, in order, that a span needs to count

#: Base phrases and their labels. Fixed values.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Notices by which works are put under public licenses. Fixed values.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nd", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3"),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-2", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2"),
    ("lgpl-3", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("agpl-3", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


@lru_cache(maxsize=1)
def _phrases() -> list[tuple[str, np.ndarray]]:
    return [(label, split([phrase]).hash) for phrase, label in PHRASES.items()]


@lru_cache(maxsize=1)
def _templates() -> list[tuple[str, np.ndarray]]:
    return [(label, split([text]).hash) for label, text in TEMPLATES]


def template_grams(spark: SparkSession) -> DataFrame:
    """gram, template (its number), place: a fixed table of a few hundred rows."""
    rows = []
    for number, (_, text) in enumerate(TEMPLATES):
        grams, places = windows(split([text]), K)
        rows += [(int(g), number, int(p)) for g, p in zip(signed(grams), places, strict=True)]
    return spark.createDataFrame(rows, "gram bigint, template int, place int")


def _places(words: Words, phrase: np.ndarray) -> np.ndarray:
    """Where the phrase begins, as indexes of words; it must lie within one text."""
    n = len(words.hash) - len(phrase) + 1
    at = np.flatnonzero(words.hash[: max(0, n)] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[words.hash[at + k] == phrase[k]]
    of = np.searchsorted(words.first, at, side="right")
    return at[of == np.searchsorted(words.first, at + len(phrase) - 1, side="right")]


def _base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, "text"):
        words = split(texts)
        n = len(texts)
        found, labels = [[] for _ in range(n)], [set() for _ in range(n)]
        for label, phrase in _phrases():
            for at in _places(words, phrase):
                t = int(np.searchsorted(words.first, at, side="right")) - 1
                found[t].append(int(at - words.first[t]))
                labels[t].add(label)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"), rows.column("text_key"), pa.array(words.counts, pa.int64()),
                pa.array([len(x) for x in found], pa.int64()), pa.array([min(x, default=None) for x in found], pa.int64()),
                pa.array([max(x, default=None) for x in found], pa.int64()), pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
            ],
            names=["doc_id", "text_key", "n_words", "n_base", "first_word", "last_word", "base"],
        )


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, "text"):
        words = split(texts)
        grams, at = windows(words, K)
        bounds = pa.array(np.searchsorted(at, words.first).astype(np.int32))
        lists = pa.ListArray.from_arrays(bounds, pa.array(signed(grams)))
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("text_key"), lists], names=["doc_id", "text_key", "grams"])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))


def spans(docs: DataFrame) -> DataFrame:
    """Merged diagonals with enough votes: doc_id, text_key, template, first and last diagonal, votes.

    Repeated rows vote together, which changes no diagonal; votes count a template's places once.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    grams = _keyed(docs).mapInArrow(_grams, f"doc_id {id_type}, text_key bigint, grams array<bigint>")
    each = grams.select("doc_id", "text_key", F.posexplode("grams").alias("at", "gram"))
    met = each.join(F.broadcast(template_grams(docs.sparkSession)), "gram")
    doc = ["doc_id", "text_key", "template"]
    diagonals = met.groupBy(*doc, (F.col("at") - F.col("place")).alias("diagonal")).agg(F.collect_set("place").alias("places"))
    in_order = Window.partitionBy(*doc).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(in_order) > DRIFT
    runs = diagonals.withColumn("run", F.sum(F.coalesce(apart.cast("int"), F.lit(1))).over(in_order))
    merged = runs.groupBy(*doc, "run").agg(
        F.min("diagonal").alias("first"), F.max("diagonal").alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("votes"),
    )
    needed = F.array(*[F.lit(VOTES * (len(words) - K + 1)) for _, words in _templates()])
    return merged.where(F.col("votes") >= F.get(needed, F.col("template")))


def likeness(own: np.ndarray, template: np.ndarray) -> float:
    """Share of the template's words that stand in `own` in order."""
    match = SequenceMatcher(None, own.tolist(), template.tolist(), autojunk=False)
    return sum(b.size for b in match.get_matching_blocks()) / len(template)


def closest(found: list[tuple[float, int, int, str]]) -> list[tuple[float, int, int, str]]:
    """Spans (likeness, begin, end, label) without those that overlap one that is more like its template.

    From the most alike down, the words of spans are marked, so the work grows with the words in spans.
    """
    taken = np.zeros(max((end for _, _, end, _ in found), default=0), dtype=bool)
    kept = []
    for _, equal in groupby(sorted(found, key=lambda x: -x[0]), key=lambda x: x[0]):
        equal = list(equal)
        kept += [x for x in equal if not taken[x[1] : x[2]].any()]
        for _, begin, end, _ in equal:
            taken[begin:end] = True
    return kept


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, "text"):
        words = split(texts)
        labels, best = [], []
        for t, some in enumerate(rows.column("spans").to_pylist()):
            own, found = words.of(t), []
            for span in some:
                label, template = _templates()[span["template"]]
                begin, end = max(0, span["first"]), min(len(own), span["last"] + len(template))
                like = likeness(own[begin:end], template)
                if like >= LIKE:
                    found.append((like, begin, end, label))
            labels.append(sorted({label for *_, label in closest(found)}))
            best.append(max((like for like, *_ in found), default=0.0))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("text_key"), pa.array(labels, pa.list_(pa.string())), pa.array(best, pa.float64())],
            names=["doc_id", "text_key", "added", "likeness"],
        )


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    `score` is the best likeness of a verified span, or 1 where a base phrase stands.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    base = materialize(
        _keyed(docs).mapInArrow(
            _base,
            f"doc_id {id_type}, text_key bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base array<string>",
        ),
        "base",
    )
    wanted = spans(docs).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("template", "first", "last")).alias("spans"))
    checked = with_findings(_keyed(docs), materialize(wanted, "spans"), "doc_id", "text_key").mapInArrow(
        _verify, f"doc_id {id_type}, text_key bigint, added array<string>, likeness double"
    )
    checked = materialize(checked.where(F.size("added") > 0), "licenses").dropDuplicates(["doc_id", "text_key"])
    checked = checked.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    added = F.coalesce("added", F.array().cast("array<string>"))
    return base.join(checked, same, "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "base").alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("base", added))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("likeness", F.lit(0.0))).alias("score"),
    )
