"""M1: segments to sentences with character offsets, times and confidence.

Only what a segment carries over to the next is a fold; all else is windows. The carry follows the
parity of the sentences found: after an odd number the last one, already given out, is carried and so
appears again; after an even number nothing is; if none was found the text stays.

A transcript that is too large for a row is folded in chunks. A chunk first takes it that nothing is carried
into it; then chunks learn what the one before really carries out, and those that took another carry are
folded anew, until no chunk learns anything new. What is carried is forgotten within a few segments, so that
two or three rounds do; where it never is, as in a transcript without a sentence end, there are as many rounds
as chunks, and the rows are right all the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions import arrays, text
from tapeloom.operators.segments import with_windows
from tapeloom.work import written

FOUND = "struct<seq:bigint,sentences:array<string>,carry:string>"


def _carried(ordered: Column, splitter: text.Splitter, start: Column) -> Column:
    """Sentences of each segment, and what it carries on, by an ordered fold over segments from the carry ``start``."""

    def step(carry: Column, x: Column) -> Column:
        buffer = F.concat(carry, x["text"], F.lit(" "))
        # The sentences are bound, so that they are found once.
        return arrays.bind(F.struct(buffer.alias("b"), splitter(buffer).alias("s")), lambda v: _next(x, v))

    def _next(x: Column, v: Column) -> Column:
        n = F.size(v["s"])
        carry = F.when(n == 0, v["b"]).when(n % 2 == 1, F.try_element_at(v["s"], F.lit(-1))).otherwise("")
        return F.struct(carry.alias("state"), F.struct(x["seq"].alias("seq"), v["s"].alias("sentences"), carry.alias("carry")).alias("given"))

    return arrays.scan(ordered, start, "string", FOUND, step)


def _in_chunks(segments: DataFrame, splitter: text.Splitter, chunk: int) -> DataFrame:
    """Rows (transcript_id, out), one for each chunk of ``chunk`` places."""
    key = ["transcript_id", "chunk"]
    ordered = F.array_sort(F.collect_list(F.struct("seq", "text")))
    whole = written(segments.withColumn("chunk", F.floor(F.col("seq") / chunk)).groupBy(*key).agg(ordered.alias("ordered")))
    out = F.element_at(_carried(F.col("ordered"), splitter, F.col("taken")), -1)["carry"]
    carries = written(whole.withColumn("taken", F.lit("")).select(*key, "taken", out.alias("carry")))
    while True:
        before = F.lag("carry", 1, "").over(Window.partitionBy("transcript_id").orderBy("chunk"))
        learned = carries.withColumn("now", before)
        wrong = written(learned.where(~F.col("taken").eqNullSafe(F.col("now"))).select(*key, F.col("now").alias("taken")))
        if wrong.isEmpty():
            return whole.join(carries.select(*key, "taken"), key).select("transcript_id", _carried(F.col("ordered"), splitter, F.col("taken")).alias("out"))
        anew = whole.join(wrong, key).select(*key, "taken", out.alias("carry"))
        carries = written(carries.join(wrong.select(*key), key, "left_anti").unionByName(anew))


def merge_segments(segments: DataFrame, splitter: str = "regex", chunk: int | None = None) -> DataFrame:
    """Rows (transcript_id, seq, pos, sentence, start_char_count, end_char_count, time_start, time_end, model_confidence_score).

    Characters ``start_char_count`` to ``end_char_count`` (inclusive) of ``merged_text`` are the sentence.
    A transcript, but no more, is held in one row; with ``chunk`` no more than the segments of that many places are.
    """
    split = text.SPLITTERS[splitter]
    if chunk is None:
        ordered = F.array_sort(F.collect_list(F.struct("seq", "text")))
        folds = segments.groupBy("transcript_id").agg(_carried(ordered, split, F.lit("")).alias("out"))
    else:
        folds = _in_chunks(segments, split, chunk)
    found = folds.select("transcript_id", F.explode("out").alias("o")).select("transcript_id", F.col("o.seq").alias("seq"), F.posexplode("o.sentences").alias("pos", "sentence"))
    upto = Window.partitionBy("transcript_id").orderBy("seq", "pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = found.withColumn("upto", F.sum(F.length("sentence").cast("long") + 1).over(upto))
    facts = with_windows(segments).select("transcript_id", "seq", "time_start", "time_end", "model_confidence_score")
    return placed.join(facts, ["transcript_id", "seq"]).select(
        "transcript_id",
        "seq",
        "pos",
        "sentence",
        (F.col("upto") - F.length("sentence") - 1).alias("start_char_count"),
        (F.col("upto") - 2).alias("end_char_count"),
        "time_start",
        "time_end",
        "model_confidence_score",
    )


def merged_text(merged: DataFrame) -> DataFrame:
    """Each transcript's sentences, a space after each; transcripts without sentences have no row."""
    parts = F.array_sort(F.collect_list(F.struct("seq", "pos", "sentence")))
    return merged.groupBy("transcript_id").agg(F.concat(F.array_join(F.transform(parts, lambda x: x["sentence"]), " "), F.lit(" ")).alias("merged_text"))
