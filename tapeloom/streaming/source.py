"""ST1: segments as they come, as a stream: a Python streaming source over a segment table that grows.

The table is a folder of versions, ``version=1`` and so on, each the Parquet files of one append. An append is
written aside and published by one rename, so that a version is there whole or not at all. The stream's
offset is the last version read: a query that starts again from its checkpoint reads the versions after it,
and a batch that is replayed reads the very files it read before, which never change.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tapeloom.schema import SEGMENT
from tapeloom.shipping import ship
from tapeloom.sources.exact import open_folder
from tapeloom.sources.versions import last, last_whole, publish, stage, versions

ship(__name__)

FORMAT = "segment_log"


def append(segments: DataFrame, path: str) -> int:
    """Adds a version with these segments, and returns its number. Of writers that meet, one takes the next number, the other the one after."""
    new = stage(segments.select([f.name for f in SEGMENT]), path)
    n = last(path) + 1
    while not publish(path, new, n):
        n += 1
    return n


@dataclass
class File(InputPartition):
    path: str

    def __init__(self, path: str):
        self.path = path


class LogReader(DataSourceStreamReader):
    def __init__(self, path: str, first: int):
        self.path, self.first = path, first

    def initialOffset(self) -> dict:
        return {"version": self.first}

    def latestOffset(self) -> dict:
        system, folder = open_folder(self.path)
        return {"version": max(self.first, last_whole(versions(system, folder)))}

    def partitions(self, start: dict, end: dict) -> list[File]:
        """A task for each file of the versions after ``start`` up to ``end``; one that is missing is an error, not a loss."""
        system, folder = open_folder(self.path)
        out = []
        for v in range(start["version"] + 1, end["version"] + 1):
            found = system.get_file_info(pafs.FileSelector(f"{folder}/version={v}"))
            out += sorted(f.path for f in found if f.base_name.endswith(".parquet"))
        return [File(p) for p in out]

    def read(self, partition: File) -> Iterator:
        import pyarrow.parquet as pq

        system, _ = open_folder(self.path)
        with system.open_input_file(partition.path) as f:
            yield from pq.ParquetFile(f).iter_batches(columns=[x.name for x in SEGMENT])

    def commit(self, end: dict) -> None:
        pass


class SegmentLog(DataSource):
    """``readStream.format("segment_log").option("path", ...)``; ``after``: the version to begin behind, 0 unless given."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return SEGMENT

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options["path"], int(self.options.get("after", 0)))


def read_stream(spark: SparkSession, path: str, after: int = 0) -> DataFrame:
    """The segments of all versions behind ``after``, those there are and those to come."""
    spark.dataSource.register(SegmentLog)
    return spark.readStream.format(FORMAT).option("path", path).option("after", after).load()
