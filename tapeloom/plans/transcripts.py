"""A whole run: videos or audio files to segments to texts, tables and reader's pages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.functions import text
from tapeloom.operators import clean, merge, naming, segments
from tapeloom.schema import Settings
from tapeloom.sources import adapters, sinks


@dataclass(frozen=True)
class Run:
    """Results of a run. ``rows`` is what the transcriber gives; all else is derived from it, lazily."""

    rows: DataFrame
    segments: DataFrame
    texts: DataFrame
    sentences: DataFrame
    kept: DataFrame
    errors: DataFrame
    names: DataFrame
    again: Callable[[DataFrame], Run]

    def write(self, path: str, settings: Settings = Settings(), folders: bool = True, exact: bool = False) -> Run:
        """All outputs below ``path``, by file name, with ``exact`` in files of that very name. Two items of one name are an error before
        anything is transcribed. The transcriber runs once: its rows are written first and the run that is returned reads them."""
        if twice := self.names.groupBy("filename").count().where("count > 1").orderBy("filename").limit(5).collect():
            raise ValueError(f"names that several items have: {[r.filename for r in twice]}; transcripts.named gives each its own")
        self.rows.write.parquet(f"{path}/transcribed")
        done = self.again(self.rows.sparkSession.read.schema(self.rows.schema).parquet(f"{path}/transcribed"))
        named = [x.join(self.names, "transcript_id") for x in (done.segments, done.texts)]
        if exact:
            sinks.write_exact(*named, path, settings.unwanted_text)
        else:
            sinks.write_all(*named, path, settings.unwanted_text, "filename", folders)
        return done


def _local(rows: DataFrame, names: DataFrame, settings: Settings, splitter: str) -> Run:
    found = rows.where("error is null").drop("error")
    return Run(
        rows=rows,
        segments=found,
        texts=segments.combined_text(found),
        sentences=segments.sentences(found, ["transcript_id", "seq"], splitter=splitter),
        kept=segments.without_text(found, settings.unwanted_text),
        errors=rows.where("error is not null").select("transcript_id", "error"),
        names=names,
        again=lambda written: _local(written, names, settings, splitter),
    )


def _remote(rows: DataFrame, names: DataFrame, settings: Settings) -> Run:
    good = rows.where("error is null")
    found = segments.from_response(good)
    return Run(
        rows=rows,
        segments=found,
        # a response without segments gives no text either.
        texts=segments.response_text(good).join(found.select("transcript_id").distinct(), "transcript_id", "left_semi"),
        sentences=rows.sparkSession.createDataFrame([], "transcript_id long, seq long, pos int, sentence string"),
        kept=segments.without_text(found, settings.unwanted_text),
        errors=rows.where("error is not null").select("transcript_id", "error"),
        names=names,
        again=lambda written: _remote(written, names, settings),
    )


def transcribe(files: DataFrame, make: Callable[[], Callable], settings: Settings = Settings(), splitter: str = "regex") -> Run:
    """E1 after download, U2: ``files`` has transcript_id, path, filename and content.

    ``make`` gives a local transcriber, or with ``use_remote`` a client that answers in JSON: then texts are those
    of the responses, numbers are not rounded and there are no sentences.
    """
    good = adapters.downloaded(files)
    names = good.select("transcript_id", "filename")
    if settings.use_remote:
        return _remote(adapters.responses(good, make, settings), names, settings)
    return _local(adapters.transcribe(good, make, settings), names, settings, splitter)


def named(videos: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Videos with a file name that no other has."""
    slugs = videos.withColumn("slug", text.slug(F.col("title")))
    return videos.join(naming.allocate(slugs, existing).drop("slug"), "seq")


def merged(rows: DataFrame, splitter: str = "regex") -> DataFrame:
    """E2."""
    return merge.merge_segments(rows, splitter)


def reader_pages(rows: DataFrame, keys: list[str], column: str = "text", splitter: str = "regex", settings: Settings = Settings()) -> DataFrame:
    """Cleaned pages and their download form."""
    html = clean.reader_html(F.col(column), splitter, settings.sentences_per_paragraph)
    return rows.select(*keys, html.alias("html")).withColumn("download", clean.paragraph_text(F.col("html")))
