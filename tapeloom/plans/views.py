"""Inputs of the queries: views of the given tables, some changed so that rarely met rules are met."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as segments; times and log probabilities follow from text lengths."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("transcript_id"), F.col("turn").alias("seq"), "text")
    upto = F.sum(F.length("text")).over(Window.partitionBy("transcript_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(
        "transcript_id",
        "seq",
        ((upto - F.length("text")) / F.lit(100.0)).alias("start"),
        (upto / F.lit(100.0)).alias("end"),
        "text",
        (-(F.length("text") % 100) / F.lit(100.0)).alias("avg_logprob"),
    )


SEGMENTS_SQL = """
segments as (
  select conv_id transcript_id, turn seq, text,
    ((sum(length(text)) over w - length(text)) / 100.0::double)::double as start,
    (sum(length(text)) over w / 100.0::double)::double as "end",
    (-(length(text) % 100) / 100.0::double)::double as avg_logprob
  from conversations
  window w as (partition by conv_id order by turn rows unbounded preceding))
"""


def with_quotes(c: Column) -> Column:
    """Q: sentence ends and open quotes."""
    return F.translate(c, "mqu", '"!?')


def with_breaks(c: Column) -> Column:
    """L: hyphenated and broken lines."""
    return F.replace(F.replace(F.replace(c, F.lit(" e"), F.lit("-\ne")), F.lit(" d"), F.lit("\nd")), F.lit(" a"), F.lit("\n"))


ABBREVIATED = {" the ": " Dr. ", " of ": " e.g. ", " und ": " u.a. ", " de ": " etc. "}


def with_abbreviations(c: Column) -> Column:
    """A: some words as abbreviations, whose stops end no sentence."""
    for word, instead in ABBREVIATED.items():
        c = F.replace(c, F.lit(word), F.lit(instead))
    return c


def with_continuations(c: Column) -> Column:
    """C: lines that end in a comma or begin with a dash."""
    return F.replace(F.replace(c, F.lit(", "), F.lit(",\n")), F.lit(" d"), F.lit("\n- d"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page titles in page order."""
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("seq"), title.alias("title"), "url")
