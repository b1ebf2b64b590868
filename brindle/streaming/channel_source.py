"""A channel as a stream source: published messages in numbered segments, heard from a chosen position on.

A segment is what one `publish` wrote; it counts once it is whole. An offset is the number of segments that a subscriber
has seen, so a subscription that starts at `latest` hears nothing from before it began, and one that is restarted from its
checkpoint goes on where it left off, whatever `start` says. Each file of the new segments is a partition of the
micro-batch and is read on an executor, in Arrow batches.

    spark.dataSource.register(ChannelSource)
    spark.readStream.format("channel").schema(schema).option("path", folder).option("start", "latest").load()

The folder must be one that pyarrow reaches from the driver and the executors. Options: `start`, which is `earliest`
(the default), `latest`, or the number of segments to pass over; `most`, how many segments a micro-batch takes at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_WHOLE = "_SUCCESS"  # written by Spark after all files of a segment


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _segment(folder: str, number: int) -> str:
    return f"{folder}/segment={number:012d}"


def segments(folder: str) -> int:
    """How many segments are whole, counted up to the first that is not."""
    store, path = _place(folder)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    numbers = sorted(int(i.base_name.split("=")[1]) for i in found if i.base_name.startswith("segment="))
    whole = 0
    for number in numbers:
        if number != whole or store.get_file_info(f"{_segment(path, number)}/{_WHOLE}").type != fs.FileType.File:
            break
        whole += 1
    return whole


def publish(messages: DataFrame, folder: str) -> int:
    """Add the messages as the next segment and return its number; one publisher at a time."""
    number = segments(folder)
    messages.write.mode("overwrite").parquet(_segment(folder, number))
    return number


@dataclass
class File(InputPartition):
    path: str


class Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.folder, self.start = options["path"], options.get("start", "earliest")
        self.most = int(options["most"]) if "most" in options else None
        self.schema = to_arrow_schema(schema)
        self.given: int | None = None  # what the last offset was, so that a micro-batch takes no more than `most`

    def initialOffset(self) -> dict:
        there = segments(self.folder)
        first = {"earliest": 0, "latest": there}.get(self.start)
        self.given = int(self.start) if first is None else first
        return {"segments": self.given}

    def latestOffset(self) -> dict:
        there = segments(self.folder)
        if self.most is not None and self.given is not None:
            there = min(there, self.given + self.most)
        self.given = max(there, self.given or 0)
        return {"segments": self.given}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.given = end["segments"]
        store, path = _place(self.folder)
        files = []
        for number in range(start["segments"], end["segments"]):
            found = store.get_file_info(fs.FileSelector(_segment(path, number)))
            files += [File(i.path) for i in found if i.base_name.endswith(".parquet")]
        return files

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        store, _ = _place(self.folder)
        with store.open_input_file(partition.path) as file:
            for batch in pq.ParquetFile(file).iter_batches(columns=self.schema.names):
                yield pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in self.schema], schema=self.schema)

    def commit(self, end: dict) -> None:
        """Segments stay; nothing is acknowledged to a publisher."""


class ChannelSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "channel"

    def schema(self) -> str:
        return "seq bigint, channel string, data string, ts timestamp"

    def streamReader(self, schema: StructType) -> Reader:
        return Reader(self.options, schema)


def listen(spark: SparkSession, folder: str, schema, start: str = "earliest", **options: str) -> DataFrame:
    """The messages of a channel folder as a stream."""
    spark.dataSource.register(ChannelSource)
    return spark.readStream.format("channel").schema(schema).options(path=folder, start=start, **options).load()
