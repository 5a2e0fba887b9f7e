"""Segment streams: offsets, restarts, early, late and missing segments."""

import time

import pytest

from tapeloom.operators import merge
from tapeloom.schema import SEGMENT
from tapeloom.streaming import merge as streaming
from tapeloom.streaming import source


def rows(*seqs, i=1):
    return [(i, s, float(s), s + 1.0, f"Word{s} one. Two" if s % 3 else f'say "x{s}.', -0.1 * s) for s in seqs]


def run_once(stream, path, name):
    q = stream.writeStream.format("parquet").option("path", f"{path}/{name}").option("checkpointLocation", f"{path}/check-{name}").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def test_restarts_neither_lose_nor_repeat(spark, tmp_path):
    log, want = f"{tmp_path}/log", []
    for n in range(4):
        more = rows(*range(5 * n, 5 * n + 5)) + rows(n, i=2)
        assert source.append(spark.createDataFrame(more, SEGMENT).repartition(2), log) == n + 1
        want += more
        if n != 1:  # the third run finds two versions
            run_once(source.read_stream(spark, log), tmp_path, "out")
        run_once(source.read_stream(spark, log, after=2), tmp_path, "tail") if n > 1 else None
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == sorted(want)
    assert spark.read.parquet(f"{tmp_path}/tail").count() == 12
    run_once(source.read_stream(spark, log), tmp_path, "out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(want)


def test_offsets(spark, tmp_path):
    reader = source.LogReader(str(tmp_path / "log"), 0)
    assert reader.latestOffset() == reader.initialOffset() == {"version": 0}
    for n in (1, 2):
        source.append(spark.createDataFrame(rows(n), SEGMENT).coalesce(1), str(tmp_path / "log"))
    (tmp_path / "log" / "version=4").mkdir()  # one that came before its turn waits
    (tmp_path / "log" / "_new-x").mkdir()
    assert reader.latestOffset() == {"version": 2}
    parts = reader.partitions({"version": 1}, {"version": 2})
    assert parts == reader.partitions({"version": 1}, {"version": 2}) and len(parts) == 1
    assert [b.num_rows for b in reader.read(parts[0])] == [1]
    with pytest.raises(FileNotFoundError):
        reader.partitions({"version": 2}, {"version": 3})


def merged(spark, path):
    return [tuple(r)[:8] for r in spark.read.parquet(path).where("not late").orderBy("transcript_id", "seq", "pos").collect()]


def test_any_order_over_batches(spark, tmp_path):
    log = f"{tmp_path}/log"
    given = [rows(7, 2, 9) + rows(1, i=2), rows(0, 8), rows(1, 3, 5) + rows(0, i=2), rows(4, 2), rows(6)]
    for batch in given:
        source.append(spark.createDataFrame(batch, SEGMENT), log)
        run_once(streaming.merge_stream(source.read_stream(spark, log)), tmp_path, "out")
    whole = spark.createDataFrame(rows(*range(10)) + rows(0, 1, i=2), SEGMENT)
    want = merge.merge_segments(whole)
    assert merged(spark, f"{tmp_path}/out") == [tuple(r)[:8] for r in want.orderBy("transcript_id", "seq", "pos").collect()]
    late = [(r.transcript_id, r.seq, r.pos, r.sentence) for r in spark.read.parquet(f"{tmp_path}/out").where("late").collect()]
    assert late == [(1, 2, None, "Word2 one. Two")]  # it came twice
    got = streaming.with_confidence(spark.read.parquet(f"{tmp_path}/out"), whole).select("transcript_id", "seq", "pos", "model_confidence_score")
    for a, b in zip(got.orderBy("transcript_id", "seq", "pos").collect(), want.orderBy("transcript_id", "seq", "pos").collect()):
        assert a.model_confidence_score == pytest.approx(b.model_confidence_score)


def test_a_gap_is_left_when_patience_ends(spark, tmp_path):
    log, out = f"{tmp_path}/log", f"{tmp_path}/out"
    source.append(spark.createDataFrame(rows(0, 2, 3), SEGMENT), log)
    stream = streaming.merge_stream(source.read_stream(spark, log), patience_s=2.0)
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/check").trigger(processingTime="0 seconds").start()
    try:
        ended = time.time() + 60
        while time.time() < ended and not {2, 3} <= {r.seq for r in spark.read.schema(streaming.OUT).parquet(out).collect()}:
            time.sleep(0.5)
        source.append(spark.createDataFrame(rows(1, 4), SEGMENT), log)
        while time.time() < ended and not {1, 4} <= {r.seq for r in spark.read.schema(streaming.OUT).parquet(out).collect()}:
            time.sleep(0.5)
    finally:
        q.stop()
    found = spark.read.schema(streaming.OUT).parquet(out)
    assert [r.seq for r in found.where("late").collect()] == [1]
    want = merge.merge_segments(spark.createDataFrame(rows(0, 2, 3, 4), SEGMENT))
    assert merged(spark, out) == [tuple(r)[:8] for r in want.orderBy("transcript_id", "seq", "pos").collect()]
