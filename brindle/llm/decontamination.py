"""Benchmark decontamination over a positional inverted index of the training texts.

The index is a table: one row per term and segment of documents, with the rows and word positions where the term
stands. Rows have numbers, so that those which share an id stay apart. Segments are what a task holds at a time, so no row grows with the corpus and building needs no shuffle.

A search takes every window of an item. Of a window's terms the two that are rarest in the corpus are looked up; their
lists, moved back by the terms' places in the item, give the places where the item would have to begin. Where both
lists give the same place there may be an exact phrase; where the places are a few words apart there may be a proximity
match, the window's words in order with a few others in between. Both are then compared word by word with the text.

A window is `size` consecutive words of an item; an item of fewer words, but not none, is one window. NULL texts have
no words. Items without an id are ignored; rows that share an item id are one item. Each row of the documents is
judged by its own text, also if ids repeat or are NULL. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.joining import packed, with_findings, without_findings
from brindle.llm.words import signed, slices, split
from brindle.session import materialize, scratch_of_its_own

SIZE = 13  # words of a window
SLOP = 3  # other words that may stand between the words of a window in a proximity match
SEGMENT = 8 << 20  # bytes of text of an index segment


def _segments(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, "text", segment):
        words = split(texts)
        ids, keys, numbers = rows.column("doc_id"), rows.column("text_key"), rows.column("row")
        sizes = words.counts.astype(np.int32)
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        place = np.arange(len(owner), dtype=np.int32) - words.first.astype(np.int32)[owner]
        order = np.argsort(words.hash, kind="stable").astype(np.int32)
        terms = words.hash[order]
        del words
        starts = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.empty(0, np.int64)
        bounds = pa.array(np.append(starts, len(terms)).astype(np.int32))
        counts = np.diff(np.append(starts, len(terms))).astype(np.int32)
        nothing = lambda kind, n: pa.nulls(n, kind)
        names = ["term", "n", "rows", "positions", "row", "doc_id", "text_key"]
        list_of = lambda values: pa.ListArray.from_arrays(bounds, values)
        if len(starts):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(terms[starts])), pa.array(counts), list_of(numbers.take(pa.array(owner[order]))),
                    list_of(pa.array(place[order])), nothing(pa.int64(), len(starts)), nothing(ids.type, len(starts)),
                    nothing(pa.int64(), len(starts)),
                ],
                names=names,
            )
        empty = lambda kind: pa.nulls(len(texts), pa.list_(kind))
        yield pa.RecordBatch.from_arrays(
            [
                nothing(pa.int64(), len(texts)), pa.array(sizes), empty(pa.int64()),
                empty(pa.int32()), numbers, ids, keys,
            ],
            names=names,
        )


def build_index(docs: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Postings (term, n, rows, positions) and documents (row, doc_id, text_key, n_words), read from one written table.

    `row` is the number of a row in this index. `text_key` is a hash of the text; with the id it tells all but repeated
    rows apart.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"term bigint, n int, rows array<bigint>, positions array<int>, row bigint, doc_id {id_type}, text_key bigint"
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("row"))
    table = materialize(rows.mapInArrow(lambda batches: _segments(batches, segment), schema), "index")
    postings = table.where(F.col("term").isNotNull()).select("term", "n", "rows", "positions")
    documents = table.where(F.col("term").isNull()).select(
        "row", "doc_id", "text_key", F.col("n").cast("bigint").alias("n_words")
    )
    return postings, documents


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, "text"):
        words = split(texts)
        bounds = pa.array(words.first.astype(np.int32))
        terms = pa.ListArray.from_arrays(bounds, pa.array(signed(words.hash)))
        yield pa.RecordBatch.from_arrays([rows.column("item_id"), terms], names=["item_id", "terms"])


def read_items(items: DataFrame) -> DataFrame:
    """Items with words: item (a number), item_id, terms (hashes of all words)."""
    id_type = items.schema["item_id"].dataType.simpleString()
    words = items.where(F.col("item_id").isNotNull()).select("item_id", "text").mapInArrow(
        _item_words, f"item_id {id_type}, terms array<bigint>"
    )
    some = words.where(F.size("terms") > 0).dropDuplicates(["item_id", "terms"])
    return materialize(some.withColumn("item", F.monotonically_increasing_id()), "items")


def rarest_pairs(postings: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """For each window the two rarest places: item, term and place of the rarest and of the next one.

    Windows with a term that is nowhere in the corpus can't occur and are left out. Many windows share a pair. A
    window of one word has no second place.
    """
    places = items.select("item", F.size("terms").alias("n_words"), F.posexplode("terms").alias("place", "term"))
    spread = postings.join(places.select("term").distinct(), "term").groupBy("term").agg(F.sum("n").alias("seen"))
    known = places.join(spread, "term", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    ahead = Window.partitionBy("item").orderBy("place").rowsBetween(0, size - 1)
    two = F.slice(F.array_sort(F.collect_list(F.struct("seen", "place", "term")).over(ahead)), 1, 2)
    windows = known.withColumn("two", two).where(F.col("place") <= F.greatest(F.lit(0), F.col("n_words") - size))
    first, second = F.col("two")[0], F.get("two", F.lit(1))
    pairs = (
        windows.where(first["seen"] > 0)
        .select(
            "item", first["term"].alias("term"), first["place"].alias("place"),
            second["term"].alias("next_term"), second["place"].alias("next_place"),
        ).distinct()
    )
    return materialize(pairs.withColumn("pair", F.monotonically_increasing_id()), "pairs")


def _lists(postings: DataFrame, wanted: DataFrame) -> DataFrame:
    """Where an item would begin, by each wanted (pair, term, place): pair, row, start."""
    found = postings.join(wanted, "term").select("pair", "place", F.explode(F.arrays_zip("rows", "positions")).alias("at"))
    return found.select(
        "pair", F.col("at.rows").alias("row"), (F.col("at.positions") - F.col("place")).alias("start")
    )


def candidates(postings: DataFrame, pairs: DataFrame, slop: int = 0) -> DataFrame:
    """Places that both lists of a pair give: item, row, start, apart (0 for phrases, up to `slop` else)."""
    rare = _lists(postings, pairs.select("pair", "term", "place"))
    nxt = _lists(
        postings,
        pairs.where(F.col("next_place").isNotNull())
        .select("pair", F.col("next_term").alias("term"), F.col("next_place").alias("place")),
    )
    cell = F.floor(F.col("start") / (slop + 1))  # starts at most `slop` apart lie in one cell or in neighbouring ones
    cells = F.explode(F.array(cell - 1, cell, cell + 1)) if slop else cell
    nearby = rare.withColumn("cell", cells)
    a, b = nearby.alias("a"), nxt.withColumn("cell", cell).alias("b")
    same = (
        (F.col("a.pair") == F.col("b.pair")) & (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.row") == F.col("b.row")) & (F.abs(F.col("a.start") - F.col("b.start")) <= slop)
    )
    both = a.join(b, same).select("a.pair", "a.row", "a.start", F.abs(F.col("a.start") - F.col("b.start")).alias("apart"))
    alone = rare.join(pairs.where(F.col("next_place").isNull()).select("pair"), "pair", "left_semi").withColumn("apart", F.lit(0))
    met = both.unionByName(alone).join(pairs.select("pair", "item"), "pair")
    return met.groupBy("item", "row", "start").agg(F.min("apart").alias("apart"))


def covered(own: np.ndarray, start: int, terms: np.ndarray, size: int) -> np.ndarray:
    """Which words of a text lie in a window of the item that begins at `start` of the text."""
    size = min(size, len(terms))
    lo, hi = max(0, start), min(len(own), start + len(terms))
    hit = np.zeros(len(own), dtype=bool)
    if hi - lo < size:
        return hit
    same = own[lo:hi] == terms[lo - start : hi - start]
    edges = np.flatnonzero(np.diff(same.astype(np.int8), prepend=0, append=0))
    for begin, end in zip(edges[::2], edges[1::2], strict=True):
        if end - begin >= size:
            hit[lo + begin : lo + end] = True
    return hit


def _verify(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, "text"):
        words = split(texts)
        places = rows.column("places").to_pylist()
        n_hit, found = [], []
        for t, some in enumerate(places):
            own = words.of(t).view(np.int64)
            hit, ids = np.zeros(len(own), dtype=bool), set()
            for p in some:
                terms = np.array(p["terms"], dtype=np.int64)
                for start in p["starts"]:
                    more = covered(own, start, terms, size)
                    if more.any():
                        hit |= more
                        ids.add(str(p["item_id"]))
            n_hit.append(int(hit.sum()))
            found.append(sorted(ids))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("text_key"), pa.array(n_hit, pa.int64()), pa.array(found, pa.list_(pa.string()))],
            names=["doc_id", "text_key", "n_hit", "item_ids"],
        )


def phrases(docs: DataFrame, documents: DataFrame, met: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """Documents with windows of items, compared word by word: doc_id, text_key, n_hit, item_ids (as sorted text).

    A document gets the places of its own text only, with the terms of each item once.
    """
    terms = items.select("item", "item_id", "terms")
    named = met.where(F.col("apart") == 0).join(documents.select("row", "doc_id", "text_key"), "row")
    starts = named.groupBy("doc_id", "text_key", "item").agg(F.collect_set("start").alias("starts"))
    places = (
        starts.join(terms, "item")
        .groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("item_id", "starts", "terms")).alias("places"))
    )
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    together = with_findings(texts, materialize(places, "places"), "doc_id", "text_key")
    checked = together.mapInArrow(
        lambda batches: _verify(batches, size), f"doc_id {id_type}, text_key bigint, n_hit bigint, item_ids array<string>"
    )
    return materialize(checked.where(F.col("n_hit") > 0), "phrases")


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE, one_in: int = 20) -> DataFrame:
    """Per document its words, those inside windows of items, the items, and whether it counts as contaminated.

    doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated: one word of `one_in` is hit, or more.
    """
    postings, documents = build_index(docs)
    known = read_items(items)
    met = materialize(candidates(postings, rarest_pairs(postings, known, size)), "met")
    exact = phrases(docs, documents, met, known, size).dropDuplicates(["doc_id", "text_key"])
    found = exact.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    joined = documents.drop("row").join(found, same, "left")
    n_hit, ids = F.coalesce("n_hit", F.lit(0)), F.coalesce("item_ids", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        ((n_hit > 0) & (one_in * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def loose(own: np.ndarray, diagonals: list[int], terms: np.ndarray, size: int, slop: int) -> dict[int, int]:
    """Places of a text where a window of the item begins whose words come in order with at most `slop` others between.

    A word of the item at place t that stands at t + d of the text lies on diagonal d; words put in between move what
    follows to higher diagonals. The result maps the place of a window's first word to the least number of words in
    between, over the item's windows that begin on one of the diagonals and hold them.
    """
    size = min(size, len(terms))
    windows = np.arange(len(terms) - size + 1)
    found: dict[int, int] = {}
    for first in diagonals:
        at = np.arange(len(terms)) + np.arange(first, first + slop + 1)[:, None]
        inside = (at >= 0) & (at < len(own))
        same = inside & (own[np.where(inside, at, 0)] == terms)
        # For each number of words put in so far, the least number from there on with which the item's word is met.
        met = np.where(same, np.arange(slop + 1)[:, None], slop + 1)
        met = np.minimum.accumulate(met[::-1])[::-1]
        met = np.vstack([met, np.full(len(terms), slop + 1)])
        moved = np.where(same[0, windows], 0, slop + 1)
        for step in range(1, size):
            moved = met[moved, windows + step]
        for window in np.flatnonzero(moved <= slop):
            place = first + int(window)
            found[place] = min(found.get(place, slop), int(moved[window]))
    return found


def _verify_loose(batches: Iterator[pa.RecordBatch], size: int, slop: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, "text"):
        words = split(texts)
        owner, item, start, apart = [], [], [], []
        for t, some in enumerate(rows.column("places").to_pylist()):
            own = words.of(t).view(np.int64)
            for p in some:
                begins = sorted({s - back for s in p["starts"] for back in range(slop + 1)})
                found = loose(own, begins, np.array(p["terms"], dtype=np.int64), size, slop)
                owner += [t] * len(found)
                item += [p["item_id"]] * len(found)
                start += found.keys()
                apart += found.values()
        at = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id").take(at), rows.column("text_key").take(at), pa.array(item, pa.string()),
                pa.array(start, pa.int64()), pa.array(apart, pa.int64()),
            ],
            names=["doc_id", "text_key", "item_id", "start", "apart"],
        )


def proximity(docs: DataFrame, items: DataFrame, size: int = SIZE, slop: int = SLOP) -> DataFrame:
    """Proximity matches: doc_id, text_key, item_id (as text), start, apart.

    The words of a window stand in the text in their order, with at most `slop` other words between the first and the
    last. `start` is the place of the first word, from 0; `apart` is the number of other words, the least over the item's
    windows that match from there. Phrases are among them, with `apart` 0. Equal rows (id and text) give a match once.
    NULL and empty texts match nothing; texts of any length are read whole.
    """
    postings, documents = build_index(docs)
    known = read_items(items)
    met = materialize(candidates(postings, rarest_pairs(postings, known, size), slop), "met")
    starts = (
        met.join(documents.select("row", "doc_id", "text_key"), "row")
        .groupBy("doc_id", "text_key", "item").agg(F.collect_set("start").alias("starts"))
        .join(known.select("item", F.col("item_id").cast("string").alias("item_id"), "terms"), "item")
    )
    places = starts.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("item_id", "starts", "terms")).alias("places"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = with_findings(texts, materialize(places, "places"), "doc_id", "text_key").mapInArrow(
        lambda batches: _verify_loose(batches, size, slop),
        f"doc_id {id_type}, text_key bigint, item_id string, start bigint, apart bigint",
    )
    return found.groupBy("doc_id", "text_key", "item_id", "start").agg(F.min("apart").alias("apart"))


def keep_clean(docs: DataFrame, items: DataFrame, size: int = SIZE, one_in: int = 20) -> DataFrame:
    """The rows of `docs` that are not contaminated, with their columns."""
    with scratch_of_its_own(docs.sparkSession) as keep:
        bad = contamination(docs, items, size, one_in).where("contaminated").select("doc_id", "text_key").distinct()
        bad = keep(bad, "contaminated")
    return without_findings(packed(docs), bad, "doc_id", "text_key").select("row.*")
