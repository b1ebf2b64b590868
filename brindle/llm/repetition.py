"""Quality rules on what a text repeats, from suffix arrays of its words.

The suffixes of the words of many texts are sorted together, each text apart, by doubling the compared length; only
suffixes that are not alone yet are sorted again. Neighbours' longest common prefixes follow from the places where a
common prefix cannot be one word shorter than that of the place before; only those are compared word by word. The
intervals of equal prefixes are the repeated substrings; those that differ in the word before are the maximal ones.

The rules: the spans of repeats of at least `LEAST_REPEAT` words, united, hold at most `MOST_COVERED` hundredths of a
text's words, and its longest repeat has at most `LONGEST_REPEAT` words. Copies of a repeat may overlap.

Texts are worked on a few megabytes at a time, whole; memory grows with the longest text alone, by about 150 bytes a
word. NULL and empty texts, and those of blanks, have no words and fail the base rule of 50 words. Repeated rows are rows
of their own. A share or length that equals its limit passes. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm.blanks import covered, numbered
from brindle.llm.words import slices

BASE_WINDOW = 3
LEAST_REPEAT = 20
MOST_COVERED = 20
LONGEST_REPEAT = 100
LEAST_WORDS = 50
SYMBOLS = b"#*$%&|<>"

COUNTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat", "n_maximal")


def suffix_array(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The places of all suffixes, text by text, in the order of their words; a suffix ends with its text."""
    n = len(ids)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[owner + 1]
    key = owner * (int(ids.max(initial=0)) + 1) + ids
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    open_ = np.flatnonzero(_shared(new))
    size = 1
    while len(open_):
        place = order[open_]
        later = np.minimum(place + size, n - 1)
        second = np.where(place + size < end[place], rank[later] + 1, 0)
        key = rank[place] << 32 | second
        by = np.argsort(key, kind="stable")
        key, place = key[by], place[by]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        order[open_] = place
        rank[place] = np.maximum.accumulate(np.where(new, open_, 0))
        open_ = open_[_shared(new)]
        size *= 2
    return order


def _shared(new: np.ndarray) -> np.ndarray:
    """Members of groups of two and more, when `new` says where a group begins."""
    alone = new.copy()
    alone[:-1] &= new[1:]
    return ~alone


def common_prefixes(ids: np.ndarray, first: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of the suffix array how many words it has in common with the one before it, inside one text."""
    n = len(ids)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[owner + 1]
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    before[(before >= 0) & (owner[np.maximum(before, 0)] != owner)] = -1
    place = np.arange(n)
    # One less than at the place before, if the words before both are equal and both stand in the text.
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] > 0) & (before[:-1] >= 0) & (ids[:-1] == ids[np.maximum(before[1:] - 1, 0)])
    follows &= (place > first[owner]) & (before > first[owner])
    length = np.zeros(n, np.int64)
    todo = np.flatnonzero(~follows & (before >= 0))
    at, step = todo, 0
    while len(at) and step < 64:
        x, y = at + step, before[at] + step
        inside = np.maximum(x, y) < end[at]
        at, x, y = at[inside], x[inside], y[inside]
        at = at[ids[x] == ids[y]]
        step += 1
        length[at] = step
    for p in at.tolist():  # long repeats: in growing pieces
        length[p] = step + _common(ids, p + step, int(before[p]) + step, int(end[p]))
    lead = np.maximum.accumulate(np.where(follows, 0, place))
    length = np.maximum(length[lead] - (place - lead), 0)
    return length[order]


def _common(ids: np.ndarray, x: int, y: int, end: int) -> int:
    room, done, piece = end - max(x, y), 0, 256
    while done < room:
        m = min(piece, room - done)
        differ = ids[x + done : x + done + m] != ids[y + done : y + done + m]
        if differ.any():
            return done + int(differ.argmax())
        done, piece = done + m, 2 * piece
    return done


@dataclass
class Repeats:
    """Maximal repeated substrings: `length` words, at the places `order[left:right]`."""

    length: np.ndarray
    left: np.ndarray
    right: np.ndarray


def maximal_repeats(ids: np.ndarray, first: np.ndarray, order: np.ndarray, common: np.ndarray, least: int) -> Repeats:
    """Intervals of the suffix array with a common prefix of `least` words and more that no word before them extends."""
    found: list[tuple[int, int, int]] = []
    inside = np.flatnonzero(common >= least)
    breaks = np.flatnonzero(np.diff(inside) > 1) + 1
    for chain in np.split(inside, breaks) if len(inside) else []:
        open_: list[tuple[int, int]] = []
        for k, length in zip(chain.tolist(), common[chain].tolist()):
            left = k - 1
            while open_ and open_[-1][0] > length:
                size, left = open_.pop()
                found.append((size, left, k))
            if not open_ or open_[-1][0] < length:
                open_.append((length, left))
        found += [(size, left, int(chain[-1]) + 1) for size, left in open_]
    rows = np.array(found, np.int64).reshape(-1, 3)
    previous = np.where(np.isin(order, first), -1 - order, ids[np.maximum(order - 1, 0)])  # nothing before is like nothing else
    changes = np.concatenate([[0], np.cumsum(previous[1:] != previous[:-1])]) if len(order) else np.zeros(1, np.int64)
    maximal = changes[rows[:, 2] - 1] > changes[rows[:, 1]]
    return Repeats(*rows[maximal].T)


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of `values` over each text."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]


def measure(ids: np.ndarray, first: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """Of each text: words in repeated windows of three, words in repeats of `least` words and more, the length of the
    longest repeat, and the number of maximal repeats of at least `least` words."""
    n = len(ids)
    order = suffix_array(ids, first)
    common = common_prefixes(ids, first, order)
    longest = np.zeros(n, np.int64)  # the longest repeat that begins at each place
    longest[order] = np.maximum(common, np.append(common[1:], 0))
    window = np.flatnonzero(longest >= BASE_WINDOW)
    long = np.flatnonzero(longest >= least)
    repeats = maximal_repeats(ids, first, order, common, least)
    owner = np.searchsorted(first, order[repeats.left], side="right") - 1
    top = np.zeros(len(first) - 1, np.int64)
    np.maximum.at(top, np.repeat(np.arange(len(first) - 1), np.diff(first)), longest)
    return {
        "n_repeat_words": _per_text(covered(window, window + BASE_WINDOW, n), first),
        "n_covered": _per_text(covered(long, long + longest[long], n), first),
        "longest_repeat": top,
        "n_maximal": np.bincount(owner, minlength=len(first) - 1),
    }


def _counts(text: bytes | None, words: list[bytes]) -> tuple[int, int, int]:
    """Code points in words, symbols, and lines with a word that equal an earlier line."""
    text = text or b""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(b"".join(words).decode(errors="replace")), len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines))


def _rows(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, "text"):
        split = numbered(texts)
        first = split.first
        counts = np.array([_counts(t, split.words[first[k] : first[k + 1]]) for k, t in enumerate(texts)], np.int64).reshape(-1, 3)
        columns = {"n_words": split.counts, "word_chars": counts[:, 0], "n_symbols": counts[:, 1], "n_dup_lines": counts[:, 2]}
        columns |= measure(split.ids, first, least)
        doc_id = batch.column(batch.schema.get_field_index("doc_id"))
        yield pa.RecordBatch.from_arrays([doc_id, *(pa.array(columns[c], pa.int64()) for c in COUNTED)], names=["doc_id", *COUNTED])


def measured(docs: DataFrame, least: int = LEAST_REPEAT) -> DataFrame:
    """doc_id and the numbers of `COUNTED` of every document."""
    narrow = docs.select("doc_id", "text")
    schema = T.StructType([narrow.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in COUNTED)])
    return narrow.mapInArrow(lambda batches: _rows(batches, least), schema)


def judge(docs: DataFrame, least: int = LEAST_REPEAT, most_covered: int = MOST_COVERED, longest: int = LONGEST_REPEAT) -> DataFrame:
    """The numbers of every document, whether it fails the base rules, and whether it passes all rules."""
    n = F.col("n_words")
    base = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * n)
    passes = (100 * F.col("n_covered") <= most_covered * n) & (F.col("longest_repeat") <= longest)
    return measured(docs, least).withColumn("base_failed", base).withColumn("kept", ~base & passes)
