"""Maximal periodic runs of words, found by recompression.

A run is a stretch of consecutive words whose smallest period is q, at least four times as long as q and at least six
words, which no neighbouring word extends keeping that period. Every run with period q holds four neighbouring points
of the grid 0, q, 2q, ..., so one point in three, compared with the next, is enough to meet it: of all periods these
points are n log n / 3. Where the two words agree, longest common extensions on a run-length grammar of the texts
(`grammar`) give the exact stretch, forwards and backwards. Of the periods of one stretch the smallest counts.

Texts are worked on a few megabytes at a time, so nothing grows but with the longest text (about 150 bytes a word).
NULL and empty texts, and those of blanks alone, have no words and no runs. Repeated rows are rows of their own. Of runs
with the same exponent the one that starts first counts, then the one of the smaller period. Empty tables give empty
results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm.blanks import covered, numbered
from brindle.llm.grammar import build
from brindle.llm.words import slices

EXPONENT = 4
SHORTEST = 6
POINTS = 1 << 20  # grid points compared at a time

#: Of each document: the number of its runs, the one of the greatest exponent, all of them, and its text without repeats.
FOUND = "n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


@dataclass
class Runs:
    """The runs of several sequences, by sequence, start and period; `start` counts from the sequence's beginning."""

    owner: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _grid(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of all grid points: the sequence, the place in it, and the period."""
    periods = counts // EXPONENT
    upto = np.cumsum(periods)
    total, at = int(upto[-1]) if len(upto) else 0, 0
    while at < total:
        part = np.arange(at, min(total, at + POINTS // 4))
        owner = np.searchsorted(upto, part, side="right")
        q = part - (upto[owner] - periods[owner]) + 1
        points = np.cumsum(((counts[owner] - 1) // q - 1) // 3 + 1)
        stop = max(1, int(np.searchsorted(points, POINTS, side="right")))
        owner, q, points = owner[:stop], q[:stop], points[:stop]
        size = np.diff(points, prepend=0)
        which = np.repeat(np.arange(stop), size)
        step = np.arange(points[-1]) - np.repeat(points - size, size)
        yield owner[which], 3 * step * q[which], q[which]
        at += stop


def find(ids: np.ndarray, first: np.ndarray) -> Runs:
    """All runs of the sequences `ids[first[t]:first[t + 1]]`."""
    grammar, found = None, []
    for owner, place, q in _grid(np.diff(first)):
        i = first[owner] + place
        agree = np.flatnonzero(ids[i] == ids[i + q])
        if not len(agree):
            continue
        grammar = grammar or build(ids, first)
        owner, i, q = owner[agree], i[agree], q[agree]
        before = grammar.extend(i, i + q, owner, forward=False)
        length = before + q + grammar.extend(i, i + q, owner, forward=True)
        long = np.flatnonzero(length >= np.maximum(SHORTEST, EXPONENT * q))
        found.append(np.stack([owner[long], (i - before)[long] - first[owner[long]], length[long], q[long]]))
    rows = np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)
    rows = rows[:, np.lexsort(rows[::-1])]  # by owner, start, length and period
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    rows = rows[:, new]  # the smallest period of each stretch
    return Runs(*rows[:, np.lexsort((rows[3], rows[1], rows[0]))])


def best(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> int:
    """The run with the greatest length / period; of equals the one with the smallest start, then period."""
    top = 0
    for k in range(1, len(start)):  # runs come by start and period
        if int(length[k]) * int(period[top]) > int(length[top]) * int(period[k]):
            top = k
    return top


def planted(doc_id: str | None, n: int) -> np.ndarray | None:
    """The query's periods: for one document in ten the original place of each word, from some word on periodic."""
    h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def _rows(batches: Iterator[pa.RecordBatch], reorder: Callable[[str | None, int], np.ndarray | None] | None) -> Iterator[pa.RecordBatch]:
    kinds = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch, texts in slices(batches, "text"):
        split = numbered(texts)
        words, ids, first = split.words, split.ids, split.first
        if reorder:
            for t, doc_id in enumerate(batch.column(batch.schema.get_field_index("_key")).to_pylist()):
                lo, hi = int(first[t]), int(first[t + 1])
                if (places := reorder(doc_id, hi - lo)) is not None:
                    ids[lo:hi] = ids[lo + places]
                    own = words[lo:hi]
                    words[lo:hi] = [own[k] for k in places.tolist()]
        runs = find(ids, first)
        at = first[runs.owner]
        dropped = covered(at + runs.start + runs.period, at + runs.start + runs.length, len(ids))
        bounds = np.searchsorted(runs.owner, np.arange(len(first)))
        columns = [[] for _ in range(7)]
        for t in range(len(texts)):
            lo, hi = int(first[t]), int(first[t + 1])
            own = slice(bounds[t], bounds[t + 1])
            s, m, q = runs.start[own], runs.length[own], runs.period[own]
            gone = dropped[lo:hi]
            kept = compress(words[lo:hi], (~gone).tolist()) if gone.any() else words[lo:hi]
            top = best(s, m, q) if len(s) else None
            one = (None, None, None) if top is None else (int(s[top]), int(m[top]), int(q[top]))
            every = [{"start": x, "length": y, "period": z} for x, y, z in zip(s.tolist(), m.tolist(), q.tolist())]
            for column, value in zip(columns, (hi - lo, len(s), *one, every, b" ".join(kept).decode(errors="replace"))):
                column.append(value)
        kept_columns = [batch.column(k) for k, n in enumerate(batch.schema.names) if n not in ("text", "_key")]
        arrays = [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 5 + [pa.list_(kinds), pa.string()])]
        names = [n for n in batch.schema.names if n not in ("text", "_key")]
        yield pa.RecordBatch.from_arrays([*kept_columns, *arrays], names=[*names, "n_words", "n_runs", "start", "length", "period", "runs", "collapsed"])


def runs(docs: DataFrame, reorder: Callable[[str | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """doc_id and `FOUND`: the runs of every document, and its words but those that only repeat a run's first period.

    `reorder(doc_id as text, n)` may give the places of the original words that a text's n words are replaced by.
    """
    narrow = docs.select("doc_id", "text", *([F.col("doc_id").cast("string").alias("_key")] if reorder else []))
    schema = T.StructType([narrow.schema["doc_id"], *T.StructType.fromDDL(FOUND)])
    return narrow.mapInArrow(lambda batches: _rows(batches, reorder), schema)


def digests(docs: DataFrame, reorder: Callable[[str | None, int], np.ndarray | None] | None = planted) -> DataFrame:
    """One row per document: the greatest run, and SHA-256 of the list of all runs and of the collapsed text."""
    found = runs(docs, reorder)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    listed = F.when(F.col("n_runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
