"""Row types. Order is data here: segments carry ``transcript_id`` and ``seq``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tapeloom.sources.pool import Calls

#: A segment as files hold it.
SEGMENT_FIELDS = T.StructType(
    [
        T.StructField("start", T.DoubleType()),
        T.StructField("end", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("avg_logprob", T.DoubleType()),
    ]
)
SEGMENT = T.StructType([T.StructField("transcript_id", T.LongType()), T.StructField("seq", T.LongType()), *SEGMENT_FIELDS.fields])
RESPONSE = T.StructType([T.StructField("text", T.StringType()), T.StructField("segments", T.ArrayType(SEGMENT_FIELDS))])
VIDEO = T.StructType([T.StructField("seq", T.LongType()), T.StructField("title", T.StringType()), T.StructField("url", T.StringType())])
STREAM = T.StructType(
    [
        T.StructField("video_seq", T.LongType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("only_audio", T.BooleanType()),
        T.StructField("url", T.StringType()),
    ]
)
SENTENCE_META = T.StructType(
    [
        T.StructField("start_char_count", T.LongType()),
        T.StructField("end_char_count", T.LongType()),
        T.StructField("time_start", T.DoubleType()),
        T.StructField("time_end", T.DoubleType()),
        T.StructField("model_confidence_score", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Settings:
    """What a run can be told; the defaults are the values that results depend on."""

    cost_per_minute: float = 0.006
    unwanted_text: str = "Subtitles by the Amara.org community"
    sentences_per_paragraph: int = 5
    model: str = "large-v3"
    remote_model: str = "whisper-1"
    beam_size: int = 10
    vad_filter: bool = True
    use_remote: bool = False
    disable_cuda: bool = False
    #: Tasks that transcribe at once at most; None: as many as the input has partitions.
    transcribe_partitions: int | None = None
    #: How a task calls a remote model.
    calls: Calls = Calls()

    def device(self, cuda: bool) -> tuple[str, str]:
        """Device and number type of a local model."""
        return ("cuda", "float16") if cuda and not self.disable_cuda else ("cpu", "auto")
