"""Steps of interval-driven batch jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.casts import to_int
from brindle.functions.text import strip_marks
from brindle.operators.ordering import row_numbers


def in_interval(df: DataFrame, epoch: str, start: int, end: int) -> DataFrame:
    """Rows modified from `start` to `end`, both included."""
    return df.where(F.col(epoch).between(start, end))


def in_time_interval(df: DataFrame, ts: str, start: int, end: int) -> DataFrame:
    """The same for a timestamp column, whole seconds counted; the scan can use the bounds."""
    first, after = [F.timestamp_seconds(F.lit(s)).cast("timestamp_ntz") for s in (start, end + 1)]
    return df.where((F.col(ts) >= first) & (F.col(ts) < after))


def run_steps(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Hand `df` from step to step; any function of a DataFrame is a step."""
    for step in steps:
        df = df.transform(step)
    return df


def after_epoch(df: DataFrame, position: int, epoch: int) -> DataFrame:
    """Rows whose column at `position` is a number above `epoch`; a header row is none."""
    return df.where(to_int(F.col(df.columns[position])) > epoch)


def reject_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no {what} in this batch")
    return df


def branch(test: bool, yes: Callable[[], DataFrame], no: Callable[[], DataFrame]) -> DataFrame:
    """Build only the plan of the branch that is taken."""
    return yes() if test else no()


def is_positive(df: DataFrame, column: str) -> bool:
    """Does the column sum to more than nothing? One row comes back."""
    total = df.agg(F.sum(column).alias("total")).first().total
    return total is not None and total > 0


def split_sheet(sheet: DataFrame, pieces: Sequence[str], distinct: str) -> tuple[DataFrame, DataFrame]:
    """Clean the texts, then the piece columns and the distinct values of one column."""
    clean = strip_marks(sheet)
    return clean.select(*pieces), clean.select(distinct).distinct()


def positional_merge(columns: dict[str, tuple[DataFrame, Sequence[Column]]]) -> DataFrame:
    """Put columns of different tables side by side by row position (from 0).

    Each entry gives a table with that column and the order of its rows. Shorter
    columns are padded with NULL. All columns meet in one grouping by position.
    """
    rows = None
    for name, (df, order) in columns.items():
        placed = row_numbers(df, [], order, "pos", start=0).select("pos", name)
        rows = placed if rows is None else rows.unionByName(placed, allowMissingColumns=True)
    return rows.groupBy("pos").agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns])


def trend(runs: DataFrame, run: str, value: str) -> DataFrame:
    """Change of a value against the run before. One row per run: a small table."""
    before = F.lag(value).over(Window.orderBy(run))
    change = F.col(value) - F.col("previous")
    return runs.withColumn("previous", before).withColumn(
        "direction",
        F.when(F.col("previous").isNull(), "first").when(change > 0, "increasing")
        .when(change < 0, "decreasing").otherwise("same"),
    )
