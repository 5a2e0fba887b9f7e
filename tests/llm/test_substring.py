"""Operator 10 against all windows."""

import hashlib
import re

import numpy as np

from tapeloom.llm import substring as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    first = {}
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                gone.update(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def planted():
    rng = np.random.default_rng(5)

    def prose(n):
        return [f"w{x}" for x in rng.integers(0, 5000, n)]

    passage, long = prose(55), prose(400)
    rows = []
    for i in range(60):
        a, b = prose(int(rng.integers(0, 90))), prose(int(rng.integers(0, 90)))
        k = int(rng.integers(40, 56))
        rows.append(a + passage[:k] + b)
    for i in range(40):
        s, n = int(rng.integers(0, 300)), int(rng.integers(45, 100))
        rows.append(prose(int(rng.integers(0, 40))) + long[s : s + n] + prose(int(rng.integers(0, 40))) + long[s : s + 60])
    rows += [prose(49), ["a"] * 200, ["a"] * 60, ["a"] * 49, passage, passage, long, long[:50], long[1:51]]
    return [" \t".join(r) for r in rows] + [None, "", " "]


def test_planted(spark, monkeypatch):
    order = np.random.default_rng(2).permutation(len(planted())).tolist()
    rows = [(i, t) for i, t in zip(order, planted())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 as doc", "2 as row", "3 as pos")
    assert sorted(map(tuple, S.substring_report(df).collect())) == brute(rows)
    monkeypatch.setattr(S, "HELD", 50)
    assert sorted(map(tuple, S.substring_report(df).collect())) == brute(rows)


def test_documents(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute(rows)
    assert sorted(map(tuple, S.substring_report(df).collect())) == want and sum(r[2] for r in want)


def test_repeated_rows_and_null_ids(spark):
    long = " ".join(map(str, range(80)))
    rows = [(None, long), (3, long), (3, long), (4, "x " + long), (4, "x " + long), (None, None)]
    got = sorted(S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=str)
    assert [(r.doc_id, r.n_words, r.n_removed) for r in got] == [(3, 80, 0), (3, 80, 0), (4, 81, 80), (4, 81, 80), (None, 0, 0), (None, 80, 80)]
    assert S.substring_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_cover():
    assert {(a - b) % S.PERIOD for a in S.COVER for b in S.COVER} == set(range(S.PERIOD))


def test_run_hashes():
    w = np.random.default_rng(0).integers(0, 2**64, 300, dtype=np.uint64)
    twice = np.concatenate([w, w[:7], w])
    for which in (0, 1):
        h = S.run_hashes(twice, 20, which)
        assert (h[:281] == h[307:]).all() and len(set(h.tolist())) == len(h) - 281 - 0


def test_texts_that_repeat_themselves(spark):
    """Thousands of places of a window in each of several texts: a row a text, and no place lost."""
    line = [f"l{i}" for i in range(7)]
    rows = [(i, " ".join([f"a{i}"] * (i % 3) + line * (60 * i + 20) + [f"b{i}"] * 60)) for i in range(8)]
    rows += [(8, " ".join(["same"] * 5000)), (9, " ".join(["same"] * 3000)), (9, " ".join(line * 30))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, S.substring_report(df).collect())) == brute(rows)
    places = {r.row: r.n for r in S.shared_anchors(S.numbered(df, "doc_id", "text")).groupBy("row").agg({"pos": "count"}).withColumnRenamed("count(pos)", "n").collect()}
    found = S.numbered(df, "doc_id", "text").coalesce(1).mapInArrow(S._anchors, S.FOUND).where("not settled")
    assert found.groupBy("h", "row").count().where("count > 1").count() == 0
    assert len(places) == len(rows) and sum(places.values()) > 2000


def test_very_long_text(spark):
    """One text of 120,000 words that repeats a passage of its own and one of another text."""
    passage, own = [f"p{i}" for i in range(80)], [f"o{i}" for i in range(70)]
    long = [f"u{i}" for i in range(60_000)] + passage + own * 3 + [f"v{i}" for i in range(60_000)]
    rows = [(1, "x y " + " ".join(passage)), (2, " ".join(long)), (3, " ".join(own))]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (82, 0, rows[0][1]) and got[3] == (70, 70, "")
    assert got[2] == (len(long), 80, " ".join(long[:60_000] + long[60_080:]))
