"""Running a stream to the end of its input and reading what it wrote.

Results go to a folder by micro-batch. A batch that runs again after a failure
overwrites its own folder, so nothing counts twice. A stream that is given a `home`
goes on there the next time it runs; without one it starts afresh.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brindle.session import exists, fresh_path

Handler = Callable[[DataFrame, int], None]


def file_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet", **options: str) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.schema(schema).options(**options).format(fmt).load(folder)


def home_of(stream: DataFrame, home: str | None) -> str:
    return home or fresh_path(stream.sparkSession, "stream")


def drain(
    stream: DataFrame, handler: Handler, mode: str = "append", home: str | None = None,
    stopped: Callable[[], bool] | None = None, live: bool = False,
) -> None:
    """Hand every micro-batch to `handler` until the waiting input is used up.

    With `live` the stream goes on waiting for input. Once `stopped` says so, the
    query is ended, and no later batch is read.
    """
    writer = stream.writeStream.outputMode(mode).foreachBatch(handler)
    writer = writer.option("checkpointLocation", f"{home_of(stream, home)}/checkpoint")
    query = (writer if live else writer.trigger(availableNow=True)).start()
    if stopped is None:
        query.awaitTermination()
        return
    while not query.awaitTermination(0.2):
        if stopped():
            query.stop()
            return


def to_batches(path: str) -> Handler:
    """A handler that stores each micro-batch under its number."""

    def handle(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return handle


def stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """What `to_batches` stored, with its `batch`; no rows where no batch came."""
    if exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], like.schema).selectExpr("*", "0 AS batch")


def drained(stream: DataFrame, mode: str = "append", shape=None, home: str | None = None) -> DataFrame:
    """Everything a stream has emitted, with its `batch`; `shape` is applied per batch."""
    spark, home = stream.sparkSession, home_of(stream, home)
    store = to_batches(f"{home}/out")
    shape = shape or (lambda batch: batch)
    drain(stream, lambda batch, number: store(shape(batch), number), mode, home)
    return stored(spark, f"{home}/out", shape(spark.createDataFrame([], stream.schema)))
