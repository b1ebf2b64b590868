"""Words of whole texts as 64-bit hashes, worked out for many texts at once with numpy.

A word is a longest run of digits, letters a-z and bytes from 0x80 on, after A-Z are lower-cased. Every such byte
of a UTF-8 text belongs to a word character, so words can be cut on bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
PIECE = 1 << 20  # bytes hashed at a time; bounds the scratch memory, not the length of a text
SLICE = 4 << 20  # bytes of text that are held as words at a time, or one longer text

_IS_WORD = np.array([48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)])
_BASE = 0x9E3779B97F4A7C15 | 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers 0..n-1 of the base, or of its inverse, modulo 2**64."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = _BASE if kind == "base" else pow(_BASE, -1, 1 << 64)
        have = np.full(max(n, PIECE + 4096), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[kind] = have
    return have[:n]


@dataclass
class Words:
    """The words of several texts: word i is `text[start[i]:end[i]]`; text t has words `first[t]` to `first[t + 1]`."""

    text: bytes
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def of(self, t: int) -> np.ndarray:
        return self.hash[self.first[t] : self.first[t + 1]]

    def owner(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def _piece_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.empty(len(codes) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_VALUE[codes] * _power("base", len(codes)), out=sums[1:])
    return mixed((sums[end] - sums[start]) * _power("inverse", len(codes) + 1)[start] + (end - start).astype(np.uint64))


def split(texts: Iterable[bytes | str | None]) -> Words:
    """The words of whole texts. NULL has none."""
    parts = [b"" if t is None else t.encode() if isinstance(t, str) else t for t in texts]
    text = b"\n".join(parts).translate(LOWER)
    codes = np.frombuffer(text, dtype=np.uint8)
    found, at = [], 0
    while at < len(codes):
        stop = min(at + PIECE, len(codes))
        while stop < len(codes):  # never cut a word: go on to the next byte that belongs to none
            gaps = np.flatnonzero(~_IS_WORD[codes[stop : stop + 4096]])
            if len(gaps):
                stop += int(gaps[0])
                break
            stop = min(stop + 4096, len(codes))
        piece = codes[at:stop]
        edges = np.flatnonzero(np.diff(_IS_WORD[piece].astype(np.int8), prepend=0, append=0))
        start, end = edges[::2], edges[1::2]
        if len(start):
            found.append((_piece_hashes(piece, start, end), start + at, end + at))
        at = stop
    if found:
        hashes, start, end = (np.concatenate(x) for x in zip(*found, strict=True))
    else:
        hashes, start, end = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    offsets = np.cumsum([0] + [len(p) + 1 for p in parts])
    return Words(text, hashes, start, end, np.searchsorted(start, offsets))


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` consecutive words within one text, and the index of each run's first word."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    mix = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        mix = mix * np.uint64(0xD6E8FEB86659FD93) + words.hash[k : k + n]
    owner = words.owner()
    inside = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return mixed(mix[inside]), inside


def field(batch: pa.RecordBatch, path: str) -> pa.Array:
    """A column, or with `row.text` the field `text` of the struct column `row`."""
    name, *inner = path.split(".")
    column = batch.column(batch.schema.get_field_index(name))
    for part in inner:
        column = column.field(part)
    return column


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Arrow batches cut into runs of rows of about `limit` bytes in `column`, with that column's values as bytes.

    `column` may be a field of a struct, as in `row.text`.
    """
    for batch in batches:
        texts = field(batch, column).cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        while at < batch.num_rows:
            room = np.cumsum(sizes[at:])
            stop = at + max(1, int(np.searchsorted(room, limit, side="right")))
            yield batch.slice(at, stop - at), texts.slice(at, stop - at).to_pylist()
            at = stop


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as Spark's bigint."""
    return x.view(np.int64)
