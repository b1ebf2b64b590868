"""String, JSON and key-name expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKS = "[,\"'`]"  # fixed value: comma and quote marks stripped before a load


def strip_marks(df: DataFrame) -> DataFrame:
    """Remove commas and quote marks from every string column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: F.regexp_replace(name, MARKS, "") for name in texts})


def capitalise(word: Column) -> Column:
    """Upper-case the first letter and leave the rest as it is."""
    return F.concat(F.upper(F.substring(word, 1, 1)), F.substr(word, F.lit(2)))


def part_of(text: Column, index: int, mark: str = ":") -> Column:
    """The field at `index` (from 0) of a delimited text, NULL when absent."""
    return F.get(F.split(text, re.escape(mark)), index)


def decoded(data: Column) -> Column:
    return F.decode(data, "UTF-8")


def glob_regex(pattern: str) -> str:
    """Anchored regular expression of a key pattern with `*` and `?`."""
    wild = {"*": ".*", "?": "."}
    return "^" + "".join(wild.get(c, re.escape(c)) for c in pattern) + "$"


def key_like(key: Column, pattern: str) -> Column:
    """Keys that fit a glob; the fixed head becomes a prefix test the scan can use."""
    head = re.split(r"[*?]", pattern, maxsplit=1)[0]
    return key.startswith(head) & key.rlike(glob_regex(pattern))


def json_number(text: Column, field: str) -> Column:
    return F.get_json_object(text, f"$.{field}").cast("bigint")
