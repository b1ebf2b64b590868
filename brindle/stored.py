"""Tables that are stored as files and changed by rewriting only the files that hold a changed key.

A table lies in a folder of its own: `data` holds Parquet files, each clustered on the key, `manifests` the list of files
of each version, and `versions` one small file per version that names its manifest. That last file is created only if
it isn't there yet, and after everything it speaks of is written: a change that fails on its way leaves the old version
as it was, and of two changes to the same version one fails. Old versions can be read until `vacuum`.

Which files a change touches is found from their key column alone, and only from row groups whose range of keys meets
that of the change. Their other rows are copied; all other files stay what and where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators.skew import plain_side
from brindle.session import hadoop, remove


class Conflict(RuntimeError):
    """Another change made the version that this one was about to make."""


@dataclass(frozen=True)
class Version:
    """A version of the table and how it came about: files read again, files written for them, files left alone."""

    number: int
    touched: int
    written: int
    kept: int


def _listed(spark: SparkSession, folder: str) -> list[str]:
    place, store = hadoop(spark, folder)
    return [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []


def versions(spark: SparkSession, base: str) -> list[int]:
    return sorted(int(n) for n in _listed(spark, f"{base}/versions") if n.isdigit())


def _manifest(spark: SparkSession, base: str, number: int) -> DataFrame:
    name = spark.read.text(f"{base}/versions/{number:012d}").first().value
    return spark.read.parquet(f"{base}/manifests/{name}")


def _files(spark: SparkSession, base: str, number: int) -> list[str]:
    """Names of a version's files under `data`; Spark holds as many names for any table it reads."""
    return [r.file for r in _manifest(spark, base, number).select("file").collect()]


def _commit(spark: SparkSession, base: str, number: int, files: list[str]) -> None:
    name = uuid.uuid4().hex
    listed = spark.createDataFrame([(f,) for f in sorted(files)], "file string")
    listed.coalesce(1).write.parquet(f"{base}/manifests/{name}")
    place, store = hadoop(spark, f"{base}/versions/{number:012d}")
    try:
        out = store.create(place, False)
    except Exception as e:
        raise Conflict(f"version {number} of {base} is there already") from e
    out.write(bytearray(name.encode()))
    out.close()


def _write(df: DataFrame, base: str, key: str, files: int) -> list[str]:
    """The rows as new files, each with a range of keys and sorted by it."""
    part = uuid.uuid4().hex
    df.repartitionByRange(max(1, files), key).sortWithinPartitions(key).write.parquet(f"{base}/data/{part}")
    return [f"{part}/{n}" for n in _listed(df.sparkSession, f"{base}/data/{part}") if n.endswith(".parquet")]


def _schema(spark: SparkSession, base: str):
    return spark.read.parquet(f"{base}/schema").schema


def create(df: DataFrame, base: str, key: str, files: int) -> Version:
    """Store `df` as the first version, in about `files` files clustered on `key`."""
    spark = df.sparkSession
    if versions(spark, base):
        raise Conflict(f"there is a table in {base}")
    df.limit(0).write.mode("overwrite").parquet(f"{base}/schema")
    written = _write(df, base, key, files)
    _commit(spark, base, 0, written)
    return Version(0, 0, len(written), 0)


def _read_files(spark: SparkSession, base: str, files: list[str]) -> DataFrame:
    schema = _schema(spark, base)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{base}/data/{f}" for f in files])


def read(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The newest version, or the one with that number."""
    number = versions(spark, base)[-1] if version is None else version
    return _read_files(spark, base, _files(spark, base, number))


def _touched(table: DataFrame, keys: DataFrame, key: str) -> list[str]:
    low, high = keys.agg(F.min(key), F.max(key)).first()
    near = table.where(F.col(key).between(F.lit(low), F.lit(high)))
    held = near.select(key, F.col("_metadata.file_path").alias("_file")).join(keys, key, "left_semi").select("_file").distinct()
    return ["/".join(r._file.split("/")[-2:]) for r in held.collect()]


def rewrite(spark: SparkSession, base: str, key: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> Version:
    """Replace the rows whose `key` is in `keys` by what `change` makes of them; it may add rows or leave some out.

    NULL is no key here: such rows stay as they are.
    """
    number = versions(spark, base)[-1]
    files = _files(spark, base, number)
    keys = plain_side(keys.select(key).where(F.col(key).isNotNull()).distinct())
    if keys.isEmpty():
        return Version(number, 0, 0, len(files))
    touched = _touched(_read_files(spark, base, files), keys, key) if files else []
    old = _read_files(spark, base, touched)
    made = change(old.join(keys, key, "left_semi")).select(*old.columns)
    written = _write(old.join(keys, key, "left_anti").unionByName(made), base, key, len(touched))
    kept = [f for f in files if f not in set(touched)]
    _commit(spark, base, number + 1, kept + written)
    return Version(number + 1, len(touched), len(written), len(kept))


def _unique(changes: DataFrame, key: str) -> DataFrame:
    changes = plain_side(changes)
    wrong = changes.groupBy(key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col(key).isNull()).limit(1).collect()
    if wrong:
        raise ValueError(f"changes need one row for each key and no NULL key: {wrong[0][key]!r} has {wrong[0].n}")
    return changes


def upsert(spark: SparkSession, base: str, key: str, changes: DataFrame) -> Version:
    """Rows of `changes` take the place of those with their key; new keys are inserted."""
    changes = _unique(changes, key)
    return rewrite(spark, base, key, changes, lambda rows: changes)


def update(spark: SparkSession, base: str, key: str, changes: DataFrame) -> Version:
    """Set the columns that `changes` has on the rows with their key; keys that are not there change nothing."""
    changes = _unique(changes, key)
    columns = [c for c in changes.columns if c != key]
    there = read(spark, base).join(changes.select(key), key, "left_semi").select(key)

    def set_columns(rows: DataFrame) -> DataFrame:
        new = changes.select(key, F.struct(*columns).alias("_new"))
        return rows.join(new, key).withColumns({c: F.col(f"_new.{c}") for c in columns}).drop("_new")

    return rewrite(spark, base, key, there, set_columns)


def delete(spark: SparkSession, base: str, key: str, keys: DataFrame) -> Version:
    """Remove the rows with these keys; files that hold none of them stay."""
    return rewrite(spark, base, key, read(spark, base).join(keys.select(key), key, "left_semi").select(key), lambda rows: rows.limit(0))


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Forget all versions but the newest `keep`, and delete what none of these names; not while a change is under way."""
    numbers = versions(spark, base)
    for number in numbers[: -max(1, keep)]:
        remove(spark, f"{base}/versions/{number:012d}")
    wanted = set().union(*[_files(spark, base, n) for n in numbers[-max(1, keep):]])
    gone = 0
    for part in _listed(spark, f"{base}/data"):
        for name in _listed(spark, f"{base}/data/{part}"):
            if name.endswith(".parquet") and f"{part}/{name}" not in wanted:
                remove(spark, f"{base}/data/{part}/{name}")
                gone += 1
    return gone
