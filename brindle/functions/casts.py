"""Casts on load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column type in the target store by kind of source column.
INTEGER, NUMBER, MOMENT, TEXT = "int", "decimal(18,2)", "timestamp_ntz", "string"


def load_type(kind: T.DataType) -> str:
    """Target type of a source column; anything else loads as text."""
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return INTEGER if not isinstance(kind, T.LongType) else "bigint"
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return NUMBER
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return MOMENT
    if isinstance(kind, T.DateType):
        return "date"
    return TEXT


def cast_for_load(df: DataFrame) -> DataFrame:
    return df.select([F.col(f.name).cast(load_type(f.dataType)).alias(f.name) for f in df.schema.fields])


def to_int(text: Column) -> Column:
    """Integer value of a text, NULL when it is none."""
    return text.try_cast("bigint")
