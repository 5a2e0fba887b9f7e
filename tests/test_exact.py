"""Files of exact names: what is there after success, failure, a killed task, a clash."""

import subprocess
import sys
import textwrap
from pathlib import Path

import pandas as pd
import pytest

from tapeloom.plans import transcripts
from tapeloom.schema import SEGMENT
from tapeloom.sources import adapters, exact, files, sinks


def there(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*") if p.is_file())


def frame(spark, rows, kind="string"):
    return spark.createDataFrame(rows, f"name string, content {kind}")


def test_names_and_contents(spark, tmp_path):
    rows = [("a b", "one\n"), ("été+%20=x", ""), ("n", None), ("100%", "\x00\r\n")]
    exact.write_files(frame(spark, rows).repartition(3), str(tmp_path / "o"), ".txt", "name", "content")
    assert {p.name: p.read_bytes() for p in (tmp_path / "o").iterdir()} == {f"{n}.txt": (c or "").encode() for n, c in rows}
    got = {r.name: r.text for r in files.read_texts(spark, str(tmp_path / "o")).collect()}
    assert got == {n: c for n, c in rows if c}
    exact.write_files(frame(spark, [("b", bytearray(b"\xff\x00"))], "binary"), f"file://{tmp_path}/o", "", "name", "content")
    assert (tmp_path / "o" / "b").read_bytes() == b"\xff\x00"
    exact.write_files(frame(spark, []), str(tmp_path / "none"), "", "name", "content")
    assert there(tmp_path / "none") == []


@pytest.mark.parametrize("rows", [[("a", "1"), ("a", "2")], [("", "x")], [(None, "x")], [("a/b", "x")], [("x" * 300, "x")], [("..", "x")]])
def test_names_that_cannot_be(spark, tmp_path, rows):
    with pytest.raises(Exception, match="not a file name|two rows have the name"):
        exact.write_files(frame(spark, [("good", "g"), *rows]).repartition(4), str(tmp_path), "", "name", "content")
    assert list(tmp_path.iterdir()) == []


def test_taken_names(spark, tmp_path):
    exact.write_files(frame(spark, [("a", "old"), ("b", "old")]), str(tmp_path), ".t", "name", "content")
    with pytest.raises(Exception, match="names that are taken"):
        exact.write_files(frame(spark, [("b", "new"), ("c", "new")]), str(tmp_path), ".t", "name", "content")
    assert there(tmp_path) == ["a.t", "b.t"]
    exact.write_files(frame(spark, [("b", "new"), ("c", "new")]), str(tmp_path), ".t", "name", "content", overwrite=True)
    assert [(tmp_path / n).read_text() for n in ("a.t", "b.t", "c.t")] == ["old", "new", "new"] and len(list(tmp_path.iterdir())) == 3


def test_attempts_that_do_not_count(tmp_path):
    """A failed and a speculative attempt beside the one whose message came."""

    def cut():
        yield ("a", "half")
        raise RuntimeError("lost")

    writer = exact.ExactWriter(str(tmp_path), ".txt", "run", False)
    with pytest.raises(RuntimeError):
        writer.write(cut())
    writer.write(iter([("a", "speculative"), ("only", "speculative")]))
    good = writer.write(iter([("a", "good")]))
    writer.commit([good])
    assert there(tmp_path) == ["a.txt"] and (tmp_path / "a.txt").read_text() == "good" and len(list(tmp_path.iterdir())) == 1


def test_a_move_that_fails_puts_all_back(tmp_path, monkeypatch):
    (tmp_path / "b").write_text("old")
    (tmp_path / "c").mkdir()  # can't be replaced by a file
    writer = exact.ExactWriter(str(tmp_path), "", "run", True)
    message = writer.write(iter([("a", "new"), ("b", "new"), ("c", "new")]))
    with pytest.raises(OSError):
        writer.commit([message])
    assert there(tmp_path) == ["b"] and (tmp_path / "b").read_text() == "old"


def test_a_killed_task(tmp_path):
    """The first attempt of a task dies in the middle; the next one's files are all there, nothing else is."""
    code = f"""
    import os, sys
    sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
    from pyspark.sql import SparkSession
    from tapeloom.sources import exact
    spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
    write = exact.ExactWriter.write
    marker = {str(tmp_path / "killed")!r}

    def dying(self, rows):
        def cut():
            for n, row in enumerate(rows):
                if n == 5 and not os.path.exists(marker):
                    open(marker, "w").close()
                    os._exit(9)
                yield row
        return write(self, cut())

    exact.ExactWriter.write = dying
    rows = spark.range(200).selectExpr("concat('f', id) name", "cast(id as string) content")
    exact.write_files(rows, {str(tmp_path / "out")!r}, ".txt", "name", "content")
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, capture_output=True, timeout=120)
    assert (tmp_path / "killed").exists()
    assert {p.name: p.read_text() for p in (tmp_path / "out").iterdir()} == {f"f{i}.txt": str(i) for i in range(200)}


def test_a_run_in_exact_files(spark, tmp_path):
    raw = [(1, "/p", "one", b"a. b\nc"), (2, "/p", "two é", b' "q", x\n'), (3, "/p", "empty", b"")]
    rows = spark.createDataFrame([(*r[:3], bytearray(r[3])) for r in raw], "transcript_id long, path string, filename string, content binary")
    transcripts.transcribe(rows, adapters.line_transcriber).write(str(tmp_path), exact=True)
    assert [f for f in there(tmp_path) if not f.startswith("transcribed/")] == [f"combined_texts/{n}.txt" for n in ("one", "two é")] + [f"metadata_tables/{n}.{e}" for n in ("one", "two é") for e in ("csv", "json")]
    assert (tmp_path / "combined_texts/one.txt").read_text() == " a. b  c "
    table = pd.read_csv(tmp_path / "metadata_tables/two é.csv")
    assert list(table.columns) == ["start", "end", "text", "avg_logprob"] and table.values.tolist() == [[0.0, 2.0, '  "q", x', -0.07]]


def test_all_segments_unwanted(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, 0.0, 1.0, "bad", -0.1), (2, 0, 0.0, 1.0, "good", -0.1)], SEGMENT)
    sinks.write_exact(rows, rows.selectExpr("transcript_id", "text combined_text"), str(tmp_path), "bad", "transcript_id")
    assert (tmp_path / "metadata_tables/1.json").read_text() == "[]"
    assert [r.text for r in files.read_segments_json(spark, f"{tmp_path}/metadata_tables").collect()] == ["good"]


def test_equal_names_are_refused_before_transcribing(spark, tmp_path):
    def make():
        raise AssertionError("transcribed")

    rows = spark.createDataFrame([(1, "/p", "same", bytearray(b"x")), (2, "/p", "same", bytearray(b"y"))], "transcript_id long, path string, filename string, content binary")
    with pytest.raises(ValueError, match="same"):
        transcripts.transcribe(rows, make).write(str(tmp_path / "o"))
    assert not (tmp_path / "o").exists()


def test_only_a_missing_folder_has_no_names(spark, tmp_path):
    assert files.taken_names(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        files.taken_names(spark, "nosuchscheme://x/y").count()
