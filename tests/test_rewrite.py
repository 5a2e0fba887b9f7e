"""K5 on what is written already: only what changes is rewritten."""

import json
import os

import pytest

from tapeloom.schema import SEGMENT
from tapeloom.sources import files, sinks

ROWS = [(1, 0, 0.0, 1.0, "a", -0.1), (1, 1, 1.0, 2.0, 'bad "x"', -0.2), (2, 0, 0.0, 1.0, "fine", -0.1), (3, 0, 0.0, 1.0, "bad", -0.1), (4, 0, 0.5, 1.0, "Bad, good", -0.1)]


def stamped(path):
    """All files, with an old time given to each."""
    out = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if not n.startswith((".", "_")):
                os.utime(f"{folder}/{n}", (1, 1))
                out[os.path.relpath(f"{folder}/{n}", path)] = open(f"{folder}/{n}").read()
    return out


@pytest.mark.parametrize("exact", [False, True])
def test_only_changed_ones(spark, tmp_path, exact):
    rows = spark.createDataFrame(ROWS, SEGMENT)
    path = str(tmp_path / "o")
    if exact:
        sinks.write_exact(rows, rows.selectExpr("transcript_id", "text combined_text").where("seq = 0"), path, None, "transcript_id")
        path += "/metadata_tables"
    else:
        sinks.write_json(rows, path)
    before = stamped(path)
    counts = sinks.drop_unwanted(spark, path, "bad", exact=exact).orderBy("transcript_id").collect()
    assert [(int(r[0]), *r[1:]) for r in counts] == [(1, 2, 1, 1), (2, 1, 1, 0), (3, 1, 0, 1), (4, 1, 1, 0)]
    got = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if not n.startswith((".", "_")) and not n.endswith(".csv"):
                i = int(n[0]) if exact else int(folder.rpartition("=")[2])
                assert i not in got
                got[i] = (os.path.getmtime(f"{folder}/{n}") == 1, json.load(open(f"{folder}/{n}")))
    assert [got[i][0] for i in (1, 2, 3, 4)] == [False, True, False, True]
    assert [[s["text"] for s in got[i][1]] for i in (1, 2, 3, 4)] == [["a"], ["fine"], [], ["Bad, good"]]
    assert got[4][1] == [{"start": 0.5, "end": 1.0, "text": "Bad, good", "avg_logprob": -0.1}]
    assert all(v == open(f"{path}/{f}").read() and os.path.getmtime(f"{path}/{f}") == 1 for f, v in before.items() if f.endswith(".csv"))
    again = stamped(path)
    assert {r.n_removed for r in sinks.drop_unwanted(spark, path, "bad", exact=exact).collect()} == {0}
    assert stamped(path) == again
    read = files.read_segments_json(spark, path) if exact else files.read_segments_json(spark, path, "transcript_id", "long")
    assert sorted(r.text for r in read.collect()) == ["Bad, good", "a", "fine"]
