"""Sinks: texts, CSV tables and JSON arrays, each with its transcript's key.

By default a transcript has its own folder, ``<key>=<value>``, with one file: what a file of that name is
elsewhere. With ``folders=False`` the same is one table, the key a column of it, which is what to use for
very many transcripts. ``write_exact`` gives each transcript files of its very name, ``<name>.txt``, ``.csv`` and
``.json``, for those who read them without Spark. Texts may have line breaks: in folders a file is a text and one line break after
it, which the reader takes off; in a table they are JSON lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.segments import without_text
from tapeloom.sources.exact import is_local, write_files, write_folders
from tapeloom.sources.files import read_folders, read_texts
from tapeloom.work import written

FIELDS = ("start", "end", "text", "avg_logprob")
CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
HEADER = ",".join(FIELDS) + "\n"


def write_text(texts: DataFrame, path: str, column: str = "combined_text", key: str = "transcript_id", folders: bool = True) -> None:
    """K2: each transcript's text as it is."""
    if folders and is_local(texts.sparkSession, path):
        write_folders(texts, path, ".txt", key, column)
    elif folders:
        texts.select(key, column).repartition(key).write.partitionBy(key).text(path)
    else:
        texts.select(key, F.col(column).alias("text")).write.json(path)


def write_csv(segments: DataFrame, path: str, key: str = "transcript_id", folders: bool = True) -> None:
    """K3: all segments in order, with a header; spaces at the edges stay and quotes are doubled."""
    if folders and is_local(segments.sparkSession, path):
        write_folders(segments, path, ".csv", key, _csv_line(), ["seq"], HEADER)
    elif folders:
        rows = segments.repartition(key).sortWithinPartitions(key, "seq").select(key, *FIELDS)
        rows.write.partitionBy(key).options(**CSV).csv(path)
    else:
        rows = segments.repartitionByRange(key, "seq").sortWithinPartitions(key, "seq")
        rows.select(key, "seq", *FIELDS).write.options(**CSV).csv(path)


def json_arrays(segments: DataFrame, key: str = "transcript_id") -> DataFrame:
    """Each transcript's segments as one JSON array, in order."""
    parts = F.array_sort(F.collect_list(F.struct("seq", *FIELDS)))
    plain = F.transform(parts, lambda x: F.struct(*[x[f].alias(f) for f in FIELDS]))
    return segments.groupBy(key).agg(F.to_json(plain, {"ignoreNullFields": "false"}).alias("json"))


def write_json(segments: DataFrame, path: str, unwanted: str | None = None, key: str = "transcript_id", folders: bool = True) -> None:
    """K4, K5: arrays of segments, without unwanted ones: filtered before writing, so that nothing is written twice."""
    rows = json_arrays(segments if unwanted is None else without_text(segments, unwanted), key)
    if folders and is_local(segments.sparkSession, path):
        write_folders(rows, path, ".txt", key, "json")
    elif folders:
        rows.write.partitionBy(key).text(path)
    else:
        rows.write.json(path)


def write_all(segments: DataFrame, texts: DataFrame, path: str, unwanted: str | None, key: str = "transcript_id", folders: bool = True) -> None:
    """A run's three outputs. Text and CSV keep unwanted segments, JSON drops them."""
    write_text(texts, f"{path}/combined_texts", key=key, folders=folders)
    write_csv(segments, f"{path}/metadata_csv", key, folders)
    write_json(segments, f"{path}/metadata_json", unwanted, key, folders)


def _csv_line() -> Column:
    """A segment as a line of CSV, without the break."""
    return F.to_csv(F.struct(*FIELDS), {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV.items() if k != "header"})


def csv_tables(segments: DataFrame, key: str = "transcript_id") -> DataFrame:
    """K3: each transcript's segments as one CSV table, header and all, in order."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("seq", _csv_line().alias("line")))), lambda x: x["line"])
    return segments.groupBy(key).agg(F.concat(F.lit(HEADER), F.array_join(lines, "\n"), F.lit("\n")).alias("csv"))


def write_exact(segments: DataFrame, texts: DataFrame, path: str, unwanted: str | None, key: str = "filename", overwrite: bool = False) -> None:
    """A run's three outputs in files named by ``key``: texts in ``combined_texts``, tables and arrays in ``metadata_tables``. Text and CSV keep unwanted segments, JSON drops them."""
    write_files(texts, f"{path}/combined_texts", ".txt", key, "combined_text", overwrite)
    write_files(csv_tables(segments, key), f"{path}/metadata_tables", ".csv", key, "csv", overwrite)
    # Also a transcript that has no wanted segment has an array, an empty one.
    arrays = json_arrays(segments if unwanted is None else without_text(segments, unwanted), key)
    named = segments.select(key).distinct().join(arrays, key, "left")
    write_files(named, f"{path}/metadata_tables", ".json", key, F.coalesce("json", F.lit("[]")), overwrite)


ARRAY = "array<struct<start:double,end:double,text:string,avg_logprob:double>>"


def drop_unwanted(spark: SparkSession, path: str, unwanted: str, key: str = "transcript_id", kind: str = "string", exact: bool = False) -> DataFrame:
    """K5: takes unwanted segments out of JSON arrays that are written already, and rewrites only the transcripts that have some.

    ``path`` has the folders of ``write_json``, or with ``exact`` the files of ``write_exact``. Which ones change is found by
    A1's counts over what is there, which are returned: (key, n_before, n_after, n_removed). Changed arrays are written
    aside first, since they come from what they replace; folders are then replaced by dynamic partition overwrite, files
    by their names. All others are not touched.
    """
    if exact:
        files = read_texts(spark, path, "*.json").select(F.col("name").alias(key), F.col("text").alias("value"))
    else:
        files = read_folders(spark, path, key, kind)
    arrays = files.select(key, F.from_json("value", ARRAY).alias("before"))
    rows = arrays.withColumn("after", F.filter("before", lambda s: ~F.contains(s["text"], F.lit(unwanted))))
    counted = rows.select(key, F.size("before").cast("long").alias("n_before"), F.size("after").cast("long").alias("n_after"), F.when(F.size("before") != F.size("after"), F.to_json("after", {"ignoreNullFields": "false"})).alias("json"))
    found = written(counted)
    changed = found.where("json is not null").select(key, "json")
    if exact:
        write_files(changed, path, ".json", key, "json", overwrite=True)
    elif is_local(spark, path):
        write_folders(changed, path, ".txt", key, "json", overwrite=True)
    else:
        changed.repartition(key).write.partitionBy(key).option("partitionOverwriteMode", "dynamic").mode("overwrite").text(path)
    return found.select(key, "n_before", "n_after", (F.col("n_before") - F.col("n_after")).alias("n_removed"))
