"""Folders of many small files: what Spark's writer and reader make of them, without their cost for each file."""

import pytest
from pyspark.sql import types as T
from pyspark.sql import functions as F

from tapeloom.schema import SEGMENT, SEGMENT_FIELDS
from tapeloom.sources import exact, files, sinks

VALUES = ["a", "é +%=/x", "b:?*[]{}^\"'#\\", "\x01\x7f", " ", "1"]


def test_folders_are_those_of_spark(spark, tmp_path):
    rows = spark.createDataFrame([(v, f"{v}\n") for v in VALUES] + [(None, "none"), ("a", "more"), ("n", None)], "k string, text string").repartition(3)
    sinks.write_text(rows, str(tmp_path / "o"), "text", "k")
    rows.repartition("k").write.partitionBy("k").text(str(tmp_path / "spark"))

    def there(path):
        return {d.name: sorted(f.read_text().split("\n")) for d in path.iterdir() if "=" in d.name for f in d.iterdir() if f.suffix == ".txt"}

    assert there(tmp_path / "o") == there(tmp_path / "spark") and len(there(tmp_path / "o")) == len(VALUES) + 2
    for path in ("o", "spark"):
        got = {(r.k, r.value) for r in files.read_folders(spark, str(tmp_path / path), "k", "string").collect()}
        assert got >= {(v, f"{v}\n\n") for v in VALUES if v != "a"} | {(None, "none\n"), ("n", "\n")}
    with pytest.raises(FileExistsError):
        sinks.write_text(rows, str(tmp_path / "o"), "text", "k")
    assert files.read_folders(spark, str(tmp_path / "o"), "k", "string").count() == len(VALUES) + 2


def test_many_files_are_few_tasks(spark, tmp_path):
    """Spark's reader takes 32 small files for a task."""
    rows = spark.range(700).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("text"))
    sinks.write_text(rows, str(tmp_path / "o"), "text", "k")
    got = files.read_written_texts(spark, str(tmp_path / "o"), "k", "long")
    assert got.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism < spark.read.text(str(tmp_path / "o")).rdd.getNumPartitions()
    assert sorted(map(tuple, got.collect())) == [(i, f"t{i}") for i in range(700)]
    assert not list((tmp_path / "o").glob("*/.*.crc")) and not list((tmp_path / "o").glob("_staged*"))
    listed = files.list_audio(spark, str(tmp_path / "o"))
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, files.read_audio(spark, str(tmp_path / "o")).drop("content").collect()))


def test_packed_texts_and_patterns(spark, tmp_path):
    import gzip

    (tmp_path / "a.txt.gz").write_bytes(gzip.compress(b"packed"))
    for name in ("b.txt", "_c.txt", ".d.txt", "e.json"):
        (tmp_path / name).write_text(name)
    assert sorted(map(tuple, files.read_texts(spark, str(tmp_path)).collect())) == [("a.txt", "packed"), ("b", "b.txt"), ("e", "e.json")]
    assert [tuple(r) for r in files.read_texts(spark, str(tmp_path), "*.json").collect()] == [("e", "e.json")]
    assert sorted(map(tuple, files.read_texts(spark, f"{tmp_path}/*.txt").collect())) == [("b", "b.txt")]


def test_commit_replaces_folders_or_puts_them_back(tmp_path, monkeypatch):
    writer = exact.FoldersWriter(str(tmp_path), ".txt", "one", False, "k", "head\n")
    writer.commit([writer.write(iter([("a", "1"), ("a", "2"), ("b", "3")]))])
    assert {p.parent.name: p.read_text() for p in tmp_path.glob("*/*")} == {"k=a": "head\n1\n2\n", "k=b": "head\n3\n"}
    new = exact.FoldersWriter(str(tmp_path), ".txt", "two", True, "k", "")
    message, rename = new.write(iter([("a", "x"), ("c", "y")])), exact.os.rename
    with monkeypatch.context() as m:
        m.setattr(exact.os, "rename", lambda a, b: rename(a, b) if "_old" in a or not b.endswith("k=c") else exec("raise OSError('full')"))
        with pytest.raises(OSError, match="full"):
            new.commit([message])
    assert {p.parent.name: p.read_text() for p in tmp_path.glob("*/*")} == {"k=a": "head\n1\n2\n", "k=b": "head\n3\n"}
    new.commit([new.write(iter([("a", "x"), ("c", "y")]))])
    assert {p.parent.name: p.read_text() for p in tmp_path.glob("*/*")} == {"k=a": "x\n", "k=b": "head\n3\n", "k=c": "y\n"}
    twice = exact.FoldersWriter(str(tmp_path), ".txt", "three", False, "k", "")
    with pytest.raises(ValueError, match="two rows"):
        twice.commit([twice.write(iter([("d", "x")])), twice.write(iter([("d", "y")]))])


def test_tables_and_arrays_are_read_as_spark_reads_them(spark, tmp_path):
    texts = [' a "q"\n ', "", None, "x\r\ny", '"', '""\n"', ",\n,", "\uffff\n\ufffe)", "\\", "end\n"]
    rows = spark.createDataFrame([(i % 3, i, float(i), None if i % 4 else 1.5, t, -0.1) for i, t in enumerate(texts)], SEGMENT)
    schema = T.StructType([*SEGMENT_FIELDS, T.StructField("transcript_id", T.LongType())])
    sinks.write_csv(rows, str(tmp_path / "csv"))
    sinks.write_json(rows, str(tmp_path / "json"))
    csv = spark.read.schema(schema).options(**files.CSV, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(str(tmp_path / "csv"))
    json = spark.read.schema(schema).option("multiLine", True).json(str(tmp_path / "json"))
    for got, want in ((files.read_segments_csv(spark, str(tmp_path / "csv"), "transcript_id", "long"), csv), (files.read_segments_json(spark, str(tmp_path / "json"), "transcript_id", "long"), json)):
        assert got.drop("name").columns == want.columns and want.count() == len(texts)
        assert sorted(map(repr, got.drop("name").collect())) == sorted(map(repr, want.collect()))
        assert got.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
