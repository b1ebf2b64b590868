"""Named queries: a function over the tables, with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.session import tune
from brindle.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Result types that every SQL engine prints alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.unix_micros(column.cast("timestamp"))
        columns.append(column.alias(field.name))
    return df.select(columns)


def query(name: str, sql: str | None = None, bigint: Sequence[str] = ()):
    """Register `fn(tables)` under `name`, with its SQL twin.

    `bigint` names integer columns that the SQL engine gives another width.
    """

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(fn(Tables(tune(spark), folder)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql:
            casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in bigint)
            SQL[name] = f"SELECT * REPLACE ({casts}) FROM (\n{sql.strip()}\n)" if casts else sql.strip()
        return fn

    return register
