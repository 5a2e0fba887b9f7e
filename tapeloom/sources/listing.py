"""Playlists as a service lists them, by a Python data source with pushed filters.

A listing is a folder with a file for each page of each playlist, ``<playlist>/<first>-<last>.jsonl``: the
places of its videos, from the first to the last, and on each line a video's ``seq``, ``title`` and ``url``.
Reading makes a task of each page. Filters on ``playlist`` and on ``seq`` reach the reader: pages of other
playlists, and pages that hold no place asked for, are never opened, so that a single video (S1) is one page.
Spark applies what the reader does not take.

Spark 4.1 keeps one reader for each load, with the filters of the plan that pushed last. So each use in a plan
needs a load of its own: ``read_listing`` twice, not one result used twice with different filters.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from tapeloom.shipping import ship
from tapeloom.sources.exact import open_folder

ship(__name__)

FORMAT = "video_listing"
SCHEMA = "playlist string, seq long, title string, url string"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def write_listing(videos: DataFrame, path: str, page: int = 50) -> None:
    """Publishes (playlist, seq, title, url) as a listing, ``page`` places to a page. Playlists are dealt by pages, so that a long one is not one task's."""
    number = F.floor(F.col("seq") / page)
    rows = videos.withColumn("number", number).repartition("playlist", "number")

    def run(batches):
        import pandas as pd

        system, folder = open_folder(path)
        frames = [b for b in batches if len(b)]
        for (playlist, n), g in pd.concat(frames).groupby(["playlist", "number"]) if frames else ():
            g = g.sort_values("seq")
            where = f"{folder}/{quote(playlist, safe='')}"
            system.create_dir(where, recursive=True)
            lines = "".join(json.dumps({"seq": int(s), "title": t, "url": u}, ensure_ascii=False) + "\n" for s, t, u in zip(g["seq"], g["title"], g["url"]))
            # Aside, then under its name: an attempt that fails leaves no page.
            with system.open_output_stream(f"{where}/_{int(n)}.tmp") as out:
                out.write(lines.encode())
            system.move(f"{where}/_{int(n)}.tmp", f"{where}/{int(g['seq'].min())}-{int(g['seq'].max())}.jsonl")
            yield pd.DataFrame({"n": [len(g)]})

    rows.select("playlist", "number", "seq", "title", "url").mapInPandas(run, "n long").agg(F.sum("n")).collect()


@dataclass
class Page(InputPartition):
    path: str
    playlist: str

    def __init__(self, path: str, playlist: str):
        self.path, self.playlist = path, playlist


class ListingReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        self.playlists: set[str] | None = None
        self.low, self.high = None, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes equality and membership of playlists, and bounds of places; gives back the rest."""
        for f in filters:
            if not self._take(f):
                yield f

    def _take(self, f: Filter) -> bool:
        column = f.attribute if isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) else None
        if column == ("playlist",) and isinstance(f, (EqualTo, In)):
            asked = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.playlists = asked if self.playlists is None else self.playlists & asked
            return True
        if column == ("seq",) and not isinstance(f, In):
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.low = max(x for x in (self.low, f.value + isinstance(f, GreaterThan)) if x is not None)
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                self.high = min(x for x in (self.high, f.value - isinstance(f, LessThan)) if x is not None)
            return True
        return False

    def _holds(self, first: int, last: int) -> bool:
        return (self.low is None or last >= self.low) and (self.high is None or first <= self.high)

    def partitions(self) -> list[Page]:
        system, folder = open_folder(self.path)
        if self.playlists is None:
            found = system.get_file_info(pafs.FileSelector(folder))
            names = [unquote(f.base_name) for f in found if f.type == pafs.FileType.Directory]
        else:
            names = [p for p in self.playlists if p is not None]
        out = []
        for playlist in sorted(names):
            for f in system.get_file_info(pafs.FileSelector(f"{folder}/{quote(playlist, safe='')}", allow_not_found=True)):
                places = re.fullmatch(r"(-?\d+)-(-?\d+)\.jsonl", f.base_name)
                if places and self._holds(int(places[1]), int(places[2])):
                    out.append(Page(f.path, playlist))
        return sorted(out, key=lambda p: p.path)

    def read(self, partition: Page) -> Iterator[tuple]:
        if not isinstance(partition, Page):  # no page holds what is asked
            return
        system, _ = open_folder(self.path)
        with system.open_input_stream(partition.path) as f:
            for line in f.read().decode().splitlines():
                v = json.loads(line)
                if self._holds(v["seq"], v["seq"]):
                    yield partition.playlist, v["seq"], v["title"], v["url"]


class VideoListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options["path"])


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """All videos of all playlists, lazily: what is asked of them decides which pages are opened. For one use in a plan, see above."""
    spark.dataSource.register(VideoListing)
    spark.conf.set(PUSHDOWN, "true")
    return spark.read.format(FORMAT).option("path", path).load()


def playlist(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A playlist's videos (seq, title, url)."""
    return read_listing(spark, path).where(F.col("playlist") == name).select("seq", "title", "url")


def video(spark: SparkSession, path: str, name: str, seq: int) -> DataFrame:
    """One video."""
    return playlist(spark, path, name).where(F.col("seq") == seq)


def places(videos: DataFrame, order: str) -> DataFrame:
    """Videos of playlists with their places from 0, in order."""
    return videos.withColumn("seq", (F.row_number().over(Window.partitionBy("playlist").orderBy(order)) - 1).cast("long"))
