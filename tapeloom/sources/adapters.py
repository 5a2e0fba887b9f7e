"""What lies outside Spark, behind small interfaces: videos, downloads, decoders, transcribers.

An adapter's calls run on executors, a partition each, and a failure of one item is a row with an
error and never fails the job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions import numbers
from tapeloom.schema import VIDEO, Settings
from tapeloom.shipping import ship
from tapeloom.sources import containers, pool

ship(__name__)


class Transcriber(Protocol):
    def __call__(self, content: bytes) -> list[dict]:
        """Segments of an audio file: dicts of start, end, text, avg_logprob."""


def single_video(spark: SparkSession, title: str, url: str) -> DataFrame:
    """S1."""
    return spark.createDataFrame([(0, title, url)], VIDEO)


def playlist(spark: SparkSession, videos: list[tuple[str, str]]) -> DataFrame:
    """A playlist's (title, url) pairs in order."""
    return spark.createDataFrame([(i, *v) for i, v in enumerate(videos)], VIDEO)


def choose(settings_single: bool, one: DataFrame, many: DataFrame) -> DataFrame:
    """P7."""
    return one if settings_single else many


def first_audio_streams(videos: DataFrame, streams: DataFrame) -> DataFrame:
    """Each video's first audio-only stream; an error where it has none."""
    rank = F.row_number().over(Window.partitionBy("video_seq").orderBy("ordinal"))
    first = streams.where("only_audio").withColumn("r", rank).where("r = 1").select(F.col("video_seq").alias("seq"), F.col("url").alias("stream_url"))
    rows = videos.join(first, "seq", "left")
    return rows.withColumn("error", F.when(F.col("stream_url").isNull(), F.concat(F.lit("no audio stream: "), F.coalesce("title", F.lit("")))))


def device_of(cuda: Column, disabled: Column) -> Column:
    """F8: device and number type of a local model on a machine that has a GPU or not."""
    on = cuda & ~disabled
    return F.struct(F.when(on, "cuda").otherwise("cpu").alias("device"), F.when(on, "float16").otherwise("auto").alias("number_type"))


def downloaded(files: DataFrame) -> DataFrame:
    """items with both a path and a name."""
    return files.where("path <> '' and filename <> ''")


def with_sizes(files: DataFrame) -> DataFrame:
    """P3."""
    return files.withColumn("size_mb", numbers.size_mb(F.col("n_bytes")))


def requested(files: DataFrame) -> DataFrame:
    """DT1: when the items were asked for, as an instant: the same whatever the session's time zone."""
    return files.withColumn("request_time", F.current_timestamp())


def with_durations(files: DataFrame, decode_ms: Callable[[bytes], float]) -> DataFrame:
    """Durations by a decoder that gives milliseconds; where it fails, ``duration_error``."""

    def run(content: pd.Series) -> pd.DataFrame:
        out = []
        for c in content:
            try:
                out.append((float(decode_ms(bytes(c))), None))
            except Exception as e:  # an item's failure is its own
                out.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(out, columns=["ms", "error"]).astype({"ms": "Float64"})

    run.__annotations__ = {"content": pd.Series, "return": pd.DataFrame}
    decoded = files.withColumn("decoded", F.pandas_udf(run, "ms double, error string")("content"))
    return decoded.withColumn("duration_s", numbers.duration_s(F.col("decoded.ms"))).withColumn("duration_error", F.col("decoded.error")).drop("decoded")


def with_file_durations(files: DataFrame, path: str = "path") -> DataFrame:
    """Durations of WAV and MP4 files by their paths. Only headers are read, not samples (see ``sources.containers``); a file that can't be read has ``duration_error``."""

    def run(paths: pd.Series) -> pd.DataFrame:
        out = []
        for p in paths:
            try:
                out.append((float(containers.file_duration_ms(p)), None))
            except Exception as e:  # an item's failure is its own
                out.append((None, pool.described(e)))
        return pd.DataFrame(out, columns=["ms", "error"]).astype({"ms": "Float64"})

    run.__annotations__ = {"paths": pd.Series, "return": pd.DataFrame}
    read = files.withColumn("read", F.pandas_udf(run, "ms double, error string")(path))
    return read.withColumn("duration_s", numbers.duration_s(F.col("read.ms"))).withColumn("duration_error", F.col("read.error")).drop("read")


def limited(rows: DataFrame, most: int | None) -> DataFrame:
    """At most ``most`` tasks, without a shuffle: contents stay where they are read."""
    return rows if most is None else rows.coalesce(most)


SEGMENTS = "transcript_id long, seq long, start double, end double, text string, avg_logprob double, error string"


def transcribe(files: DataFrame, make: Callable[[], Transcriber], settings: Settings = Settings()) -> DataFrame:
    """Segments of (transcript_id, content) rows.

    ``make`` loads a model, once for each partition. Local segments have their numbers rounded. A file
    without segments gives no row, one that fails a row with an error.
    """
    remote = settings.use_remote

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for batch in batches:
            out = []
            for i, content in zip(batch["transcript_id"], batch["content"]):
                try:
                    for seq, s in enumerate(model(bytes(content))):
                        values = [s.get("start", 0), s.get("end", 0), s.get("text", ""), s.get("avg_logprob", 0)]
                        if not remote:
                            values = [v if k == 2 or v is None else round(v, 2) for k, v in enumerate(values)]
                        out.append((i, seq, *values, None))
                except Exception as e:  # an item's failure is its own
                    out.append((i, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            frame = pd.DataFrame(out, columns=["transcript_id", "seq", "start", "end", "text", "avg_logprob", "error"])
            yield frame.astype({"transcript_id": "Int64", "seq": "Int64", "start": "Float64", "end": "Float64", "avg_logprob": "Float64"})

    rows = files.select(F.col("transcript_id").cast("long").alias("transcript_id"), "content")
    return limited(rows, settings.transcribe_partitions).mapInPandas(run, SEGMENTS)


RESPONSES = "transcript_id long, body string, error string"
#: Rows, and characters of answers, in a batch.
ROWS, BODIES = 64, 1 << 20


def check_body(body: str) -> None:
    """An error where a response can't be read as one: not JSON, not an object, segments that are not a list of objects."""
    answer = json.loads(body)
    if not isinstance(answer, dict):
        raise ValueError("the response is not an object")
    segments = answer.get("segments", [])
    if not isinstance(segments, list) or not all(isinstance(s, dict) for s in segments):
        raise ValueError("segments are not a list of objects")


def responses(files: DataFrame, make: Callable[[], Callable[[bytes], str]], settings: Settings = Settings()) -> DataFrame:
    """A remote model's JSON answer to each (transcript_id, content), as it came.

    ``make`` makes a client, once for each partition: a function or a coroutine function. A task has
    ``settings.calls.width`` calls under way at most, tries again what may pass, and keeps the order of its rows
    (see ``sources.pool``); ``transcribe_partitions`` times the width is what the service sees. A call that fails
    for good, and an answer that can't be read, is a row with an error.
    """
    how = settings.calls

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make()
        # One content at a time: a batch's are not all made into objects.
        items = ((i.as_py(), content.as_py()) for batch in batches for i, content in zip(batch.column(0), batch.column(1)))
        out, size = [], 0
        for i, body, error in pool.ordered(client, items, how):
            if error is None:
                try:
                    check_body(body)
                except Exception as e:  # an item's failure is its own
                    body, error = None, pool.described(e)
            out.append((i, body, error))
            size += len(body or "")
            if len(out) == ROWS or size >= BODIES:
                yield answers(out)
                out, size = [], 0
        if out:
            yield answers(out)

    def answers(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.string(), pa.string()))], names=["transcript_id", "body", "error"])

    rows = files.select(F.col("transcript_id").cast("long").alias("transcript_id"), "content")
    return limited(rows, settings.transcribe_partitions).mapInArrow(run, RESPONSES)


def line_transcriber() -> Transcriber:
    """A stand-in without a model: each line that isn't empty is a segment of two seconds."""

    def run(content: bytes) -> list[dict]:
        lines = [x for x in content.decode().split("\n") if x]
        return [{"start": 2.0 * i, "end": 2.0 * i + 2.0, "text": f" {x}", "avg_logprob": -(len(x) % 100) / 100.0} for i, x in enumerate(lines)]

    return run


def line_client() -> Callable[[bytes], str]:
    """A stand-in for a remote model: the segments of ``line_transcriber`` in a response, whose text has no spaces added."""
    model = line_transcriber()
    return lambda content: json.dumps({"text": "".join(s["text"] for s in model(content)), "segments": model(content)})
