"""Operators over segments (transcript_id, seq, start, end, text, avg_logprob)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tapeloom.functions import numbers, text


def per_transcript(ordered: bool = True):
    w = Window.partitionBy("transcript_id")
    return w.orderBy("seq").rowsBetween(Window.unboundedPreceding, 0) if ordered else w


def from_local(rows: DataFrame) -> DataFrame:
    """A local model's segments; the three numbers are rounded."""
    return rows.withColumns({c: numbers.round2(F.col(c)) for c in ("start", "end", "avg_logprob")})


def from_response(rows: DataFrame, body: str = "body", **defaults) -> DataFrame:
    """Segments of a JSON response (transcript_id, body). An absent key has a default, a null stays null."""
    default = {"start": "0", "end": "0", "text": '""', "avg_logprob": "0"} | defaults
    kinds = {"start": "double", "end": "double", "text": "string", "avg_logprob": "double"}
    parts = F.coalesce(F.from_json(F.get_json_object(body, "$.segments"), "array<string>"), F.array().cast("array<string>"))
    one = rows.select("transcript_id", F.posexplode(parts).alias("seq", "one"))

    def field(name: str) -> Column:
        given = F.array_contains(F.json_object_keys("one"), name)
        value = F.get_json_object("one", f"$.{name}")
        return F.when(given, value).otherwise(F.lit(default[name].strip('"'))).cast(kinds[name]).alias(name)

    return one.select("transcript_id", F.col("seq").cast("long").alias("seq"), *[field(n) for n in kinds])


def response_text(rows: DataFrame, body: str = "body") -> DataFrame:
    """A3 for a response: its own text."""
    return rows.select("transcript_id", F.get_json_object(body, "$.text").alias("combined_text"))


def without_text(segments: DataFrame, unwanted: str) -> DataFrame:
    """segments whose text doesn't hold the literal ``unwanted``, letter for letter. A null text goes."""
    return segments.where(~F.contains("text", F.lit(unwanted)))


def removed_counts(segments: DataFrame, unwanted: str) -> DataFrame:
    """A1: segments before, after and removed."""
    has = F.contains("text", F.lit(unwanted))
    counts = segments.groupBy("transcript_id").agg(F.count("*").alias("n_before"), F.count_if(~has).alias("n_after"))
    return counts.withColumn("n_removed", F.col("n_before") - F.col("n_after"))


def observed(segments: DataFrame, unwanted: str, name: str = "segments") -> tuple[DataFrame, Observation]:
    """K6: the segments without unwanted ones, and counts that are there once an action has run over them: no extra pass."""
    seen = Observation(name)
    has = F.contains("text", F.lit(unwanted))
    return without_text(segments.observe(seen, F.count("*").alias("n_before"), F.count_if(has).alias("n_removed")), unwanted), seen


def logprob_range(segments: DataFrame) -> DataFrame:
    """A2."""
    return segments.groupBy("transcript_id").agg(F.min("avg_logprob").alias("min_logprob"), F.max("avg_logprob").alias("max_logprob"))


def combined_text(segments: DataFrame) -> DataFrame:
    """A3: each transcript's text, a space after every segment."""
    parts = F.array_sort(F.collect_list(F.struct("seq", "text")))
    return segments.groupBy("transcript_id").agg(F.concat(F.array_join(F.transform(parts, lambda x: x["text"]), " "), F.lit(" ")).alias("combined_text"))


def with_windows(segments: DataFrame) -> DataFrame:
    """Running mean from the transcript's start, first start, own end, confidence. One shuffle, one sort."""
    w, whole = per_transcript(), per_transcript(ordered=False)
    rows = segments.withColumns(
        {
            "running_logprob": F.avg("avg_logprob").over(w),
            "time_start": F.first("start").over(w),
            "min_logprob": F.min("avg_logprob").over(whole),
            "max_logprob": F.max("avg_logprob").over(whole),
        }
    )
    return rows.withColumn("time_end", F.col("end")).withColumn("model_confidence_score", numbers.confidence(F.col("running_logprob"), F.col("min_logprob"), F.col("max_logprob")))


def sentences(rows: DataFrame, keys: list[str], column: str = "text", splitter: str = "regex") -> DataFrame:
    """A4: one row for each sentence, numbered by ``pos`` within its row. No shuffle."""
    split = text.SPLITTERS[splitter]
    return rows.select(*keys, F.posexplode(split(F.col(column))).alias("pos", "sentence"))
