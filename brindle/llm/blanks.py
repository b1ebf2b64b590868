"""Words between blanks (space and \\x09 to \\x0D), case kept, of whole texts, numbered exactly."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import count

import numpy as np


@dataclass
class Numbered:
    """The words of several texts; text t has words `first[t]` to `first[t + 1]`. Equal words have equal numbers."""

    words: list[bytes]
    ids: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def numbered(texts: Iterable[bytes | None]) -> Numbered:
    """NULL has no words. About 60 bytes of memory for each word; no text is shortened."""
    words, first = [], [0]
    for text in texts:
        words += (text or b"").split()  # of bytes, so at the six ASCII blanks alone
        first.append(len(words))
    number = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    return Numbered(words, ids, np.array(first, np.int64))


def covered(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the spans from `start` to before `end`."""
    edges = np.bincount(start, minlength=n + 1)[: n + 1] - np.bincount(end, minlength=n + 1)[: n + 1]
    return np.cumsum(edges[:n]) > 0
