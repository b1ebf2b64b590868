"""Token counts of whole texts, as a public tokenizer gives them.

Texts are encoded in batches inside Arrow functions that return lengths only. A text is split where the tokenizer is
bound to split too: before a single space that stands between two characters that are no white space. No piece of
the tokenizer's pattern reaches over such a place, nor does a special token, so the lengths of the parts add up. Equal
parts are encoded once per task; what is still unknown goes to the tokenizer in batches of about equal bytes.

NULL counts as the empty text, with no token. Repeated rows each get their count. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.words import slices

BATCH = 1 << 18  # bytes given to the tokenizer at a time
REMEMBERED = 400_000  # parts whose length a task remembers; when full, it starts anew
LONG_PART = 200  # characters; longer parts are not remembered

#: What Rust and Python both take for "no white space" on both sides, so that the pattern has a border there.
_BORDER = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already gives each core a task
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def parts_of(text: str) -> list[str]:
    """The text cut at safe borders; the parts put together are the text."""
    first, *others = _BORDER.split(text)
    return [first, *(" " + p for p in others)]


def _encode(path: str, parts: list[str], batch: int) -> Iterator[tuple[str, int]]:
    """Lengths of the parts, encoded in batches of about `batch` bytes."""
    at, size = 0, 0
    for k, part in enumerate(parts):
        size += len(part.encode())
        if size >= batch or k == len(parts) - 1:
            some = parts[at : k + 1]
            encoded = _tokenizer(path).encode_batch_fast(some, add_special_tokens=False)
            yield from zip(some, map(len, encoded), strict=True)
            at, size = k + 1, 0


def count_texts(path: str, texts: list[str], known: dict[str, int], batch: int = BATCH) -> list[int]:
    """Tokens of each text. `known` remembers the lengths of parts from call to call."""
    if len(known) > REMEMBERED:
        known.clear()
    cut = [parts_of(t) for t in texts]
    fresh = dict.fromkeys(p for parts in cut for p in parts if p not in known)
    lengths = dict(_encode(path, list(fresh), batch))
    known.update((p, n) for p, n in lengths.items() if len(p) <= LONG_PART)
    get = known.get
    return [sum(n if (n := get(p)) is not None else lengths[p] for p in parts) for parts in cut]


def _counts(batches: Iterator[pa.RecordBatch], path: str, batch: int) -> Iterator[pa.RecordBatch]:
    known: dict[str, int] = {}
    for rows, texts in slices(batches, "text"):
        texts = [t or b"" for t in texts]
        tokens = count_texts(path, [t.decode("utf-8", "replace") for t in texts], known, batch)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(np.array(tokens, np.int64))],
            names=["doc_id", "n_bytes", "n_tokens"],
        )


def token_counts(docs: DataFrame, tokenizer: str, limit: int, batch: int = BATCH) -> DataFrame:
    """Per document its bytes in UTF-8, its tokens, and whether these are more than `limit`.

    `tokenizer` is the path of a tokenizers file that every executor has.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(
        lambda batches: _counts(batches, tokenizer, batch), f"doc_id {id_type}, n_bytes bigint, n_tokens bigint"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
