"""Files: segments as JSON arrays and CSV, texts, audio, and which names are taken."""

from __future__ import annotations

import bz2
import gzip
import os
import zlib
from collections.abc import Iterator
from fnmatch import fnmatchcase
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tapeloom.functions import text
from tapeloom.schema import SEGMENT_FIELDS
from tapeloom.shipping import ship
from tapeloom.sources.exact import NO_VALUE, is_local, open_folder

ship(__name__)

#: Name of the file without folders and ending.
STEM = r"([^/]+?)(?:\.[^./]*)?$"
CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}


def file_stem() -> Column:
    """The name of the file that a row comes from, letter for letter, without its ending."""
    # Spark gives it as in an address: escaped, but for a plus sign.
    return F.regexp_extract(F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))), STEM, 1)


#: Bytes of contents, and files, that a batch has at most, but for one large file.
BATCH_BYTES, BATCH_FILES = 4 << 20, 2_000
FOUND = "path binary, name binary, folder binary, n_bytes long, content binary"
#: Files that Spark's text reader unpacks, by their endings; a folder with one of the others is an error.
UNPACK = {b".gz": gzip.decompress, b".bz2": bz2.decompress, b".deflate": zlib.decompress}
PACKED = (*UNPACK, b".lz4", b".snappy", b".zst", b".passthrough")


def _walk(folder: bytes, share: int, shares: int) -> Iterator[tuple[bytes, bytes, bytes | None]]:
    """(path, name, value) of the files in a folder, and in its folders ``key=value``, whose own names fall to a share."""
    with os.scandir(folder) as entries:
        for e in entries:
            if e.name[:1] in (b"_", b".") and b"=" not in e.name or zlib.crc32(e.name) % shares != share:
                continue
            if not e.is_dir():
                yield e.path, e.name, None
            elif b"=" in e.name:
                value = unquote_to_bytes(e.name.partition(b"=")[2])
                yield from ((f, n, None if value == NO_VALUE.encode() else value) for f, n, _ in _walk(e.path, 0, 1))


def _found(spark: SparkSession, path: str, contents: bool, pattern: str = "*") -> DataFrame | None:
    """The files of a local folder, as Spark lists them, or None if that is not what the path is.

    Each task goes through the folder's names and takes its share of them, so that no listing is held whole, and many small files are one
    task's work: Spark's readers take 32 of them at most for a task.
    """
    if not _is_folder(spark, path):
        return None
    folder = open_folder(path)[1]
    shares = 2 * spark.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for share in b.column(0).to_pylist():
                rows, size = [], 0
                for file, name, value in _walk(folder.encode(), share, shares):
                    if not fnmatchcase(name, pattern.encode()):
                        continue
                    if contents:
                        with open(file, "rb") as f:
                            content = f.read()
                        n = len(content)
                        if n and name.endswith(PACKED):
                            content = UNPACK[os.path.splitext(name)[1]](content)
                    else:
                        content, n = None, os.stat(file).st_size
                    if not n:
                        continue
                    rows.append((file, name, value, n, content))
                    size += n if contents else 0
                    if size >= BATCH_BYTES or len(rows) == BATCH_FILES:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.binary()] * 3 + [pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in FOUND.split(", ")])

    return spark.range(0, shares, 1, shares).mapInArrow(run, FOUND)


def _is_folder(spark: SparkSession, path: str) -> bool:
    return is_local(spark, path) and os.path.isdir(open_folder(path)[1])


def _csv_records(c: Column) -> Column:
    """The records of a CSV table with a header, which goes. Line breaks inside quotes part nothing."""

    def cut(x: Column) -> Column:
        quoted = F.transform(F.split(x, '"'), lambda p, i: F.when(i % 2 == 1, F.replace(p, F.lit("\n"), F.lit(text.MARK))).otherwise(p))
        lines = F.split(F.array_join(quoted, '"'), "\n")
        return F.transform(F.filter(F.slice(lines, 2, F.size(lines)), lambda r: r != ""), lambda r: F.replace(r, F.lit(text.MARK), F.lit("\n")))

    return F.when(F.contains(c, F.lit(text.MARK)), F.transform(cut(text.escape(c)), text.unescape)).otherwise(cut(c))


def read_segments_json(spark: SparkSession, path: str, key: str | None = None, kind: str = "string") -> DataFrame:
    """Rows of JSON arrays of segments, with their file's name, or the ``key`` of their folder."""
    if key is not None and _is_folder(spark, path):
        found = read_folders(spark, path, key, kind).select(key, F.from_json("value", T.ArrayType(SEGMENT_FIELDS)).alias("all"))
        # What can't be read is a row of nulls, as Spark's reader has it.
        none = F.array(F.lit(None).cast(SEGMENT_FIELDS))
        return found.select(key, F.explode(F.coalesce("all", none)).alias("s")).select("s.*", key)
    schema = SEGMENT_FIELDS if key is None else T.StructType([*SEGMENT_FIELDS, T.StructField(key, T._parse_datatype_string(kind))])
    rows = spark.read.schema(schema).options(multiLine=True, pathGlobFilter="*.json" if key is None else "*").json(path)
    return rows.select(file_stem().alias("name"), "*") if key is None else rows


def read_segments_csv(spark: SparkSession, path: str, key: str | None = None, kind: str = "string") -> DataFrame:
    """Rows of CSV tables of segments, with their file's name, or the ``key`` of their folder."""
    if key is not None and _is_folder(spark, path):
        found = read_folders(spark, path, key, kind).select(key, F.explode(_csv_records(F.col("value"))).alias("record"))
        options = {"quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        return found.select(key, F.from_csv("record", F.lit(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SEGMENT_FIELDS)), options).alias("s")).select("s.*", key)
    schema = SEGMENT_FIELDS if key is None else T.StructType([*SEGMENT_FIELDS, T.StructField(key, T._parse_datatype_string(kind))])
    rows = spark.read.schema(schema).options(**CSV, pathGlobFilter="*.csv" if key is None else "*").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return rows.select(file_stem().alias("name"), "*") if key is None else rows


def read_texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Whole text files, one row each, of names that fit the pattern."""
    if (found := _found(spark, path, True, pattern)) is not None:
        return found.select(F.regexp_extract(F.col("name").cast("string"), STEM, 1).alias("name"), F.col("content").cast("string").alias("text"))
    rows = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
    return rows.select(file_stem().alias("name"), F.col("value").alias("text"))


def read_folders(spark: SparkSession, path: str, key: str, kind: str) -> DataFrame:
    """Whole text files in folders ``<key>=<value>``: value and key."""
    if (found := _found(spark, path, True)) is not None:
        return found.select(F.col("content").cast("string").alias("value"), F.col("folder").cast("string").cast(kind).alias(key))
    return spark.read.schema(f"value string, `{key}` {kind}").text(path, wholetext=True)


def read_written_texts(spark: SparkSession, path: str, key: str = "transcript_id", kind: str = "string") -> DataFrame:
    """What ``sinks.write_text`` wrote in folders: key and text, without the line break after it."""
    rows = read_folders(spark, path, key, kind)
    return rows.select(key, F.expr("substring(value, 1, length(value) - 1)").alias("text"))


def read_audio(spark: SparkSession, path: str) -> DataFrame:
    """Audio files: path, name, bytes and content."""
    rows = spark.read.format("binaryFile").load(path)
    return rows.select("path", F.regexp_extract("path", STEM, 1).alias("filename"), F.col("length").alias("n_bytes"), "content")


def list_audio(spark: SparkSession, path: str) -> DataFrame:
    """Audio files without their content, which is not read: path, name and bytes. Spark passes over empty files."""
    if (found := _found(spark, path, False)) is not None:
        where = F.concat(F.lit("file:"), F.col("path").cast("string"))
        return found.select(where.alias("path"), F.regexp_extract(where, STEM, 1).alias("filename"), "n_bytes")
    return read_audio(spark, path).drop("content")


def taken_names(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Names of the files below ``path``, or the values of ``key`` of the folders that sinks write, by Spark's own listing; none if there is no such place."""
    try:
        rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "name string")
    if key is None:
        return rows.select(F.regexp_extract("path", STEM, 1).alias("name"))
    # Escaped in the folder's name; a plus sign is one.
    value = F.replace(F.regexp_extract("path", rf"/{key}=([^/]*)/[^/]*$", 1), F.lit("+"), F.lit("%2B"))
    return rows.select(F.url_decode(value).alias("name")).distinct()
