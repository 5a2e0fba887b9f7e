"""Operator 6: exact base score, filter against true counts, held-out likelihood."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tapeloom.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(t):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]


def brute(rows):
    train = Counter(w for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1 for w in tokens(t))
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((train[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        out.append((i, i is not None and zlib.crc32(str(i).encode()) % 5 == 1, len(w), sum(train[x] > 0 for x in w), n, base))
    return sorted(out, key=str)


def check(got, want):
    got = sorted((tuple(r) for r in got), key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
    return got


def test_documents(spark, sf_dir):
    odd = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "É É x"), (10**6 + 3, "w " * 30000), (None, "a b"), (10**6 + 2, "É É x")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string")).selectExpr("*", "1 as n_tokens", "2 as word", "3 as score")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = check(lm.score_texts(docs).collect(), want)
    unseen = [r for r in got if r[1]]
    assert sum(r[6] for r in unseen) > sum(r[5] for r in unseen)
    assert all(r[6] <= 1e-9 for r in got)
    # With a filter that is not broadcast and few broadcast words: the same.
    for per in (1, 3):
        again = check(lm.score_texts(docs, broadcast_bytes=lm.BLOCK, part_bytes=per * lm.BLOCK, frequent=50).collect(), want)
        assert [r[6] for r in again] == pytest.approx([r[6] for r in got])


def brute_scores(rows):
    """The model with true counts in place of those of the filter."""
    texts = [(i, tokens(t)) for i, t in rows]
    train = [w for i, w in texts if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    one, two = Counter(x for w in train for x in w), Counter(p for w in train for p in zip([None, *w[:-1]], w))
    n, v = sum(one.values()), len(one)

    def level(c):
        return lm.COUNT_OF[c.bit_length()]

    out = []
    for _, w in texts:
        total = 0.0
        for p in zip([None, *w[:-1]], w):
            alone = (level(one[p[1]]) + 0.5) / (n + 0.5 * (v + 1))
            before = level(one[p[0]])
            total += math.log10(min(1.0, (min(level(two[p]), before) + lm.PRIOR * alone) / (before + lm.PRIOR)))
        out.append(total)
    return out


def test_scores_against_true_counts(spark, sf_dir):
    def both(rows):
        got = [(r.doc_id, r.score) for r in lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
        want = dict(zip([r[0] for r in rows], brute_scores(rows)))
        return np.array([g for _, g in got]), np.array([want[i] for i, _ in got])

    # A filter that is nearly empty gives no false answer: the model is exact.
    rng = np.random.default_rng(4)
    small = [(i, " ".join(f"w{int(k)}" for k in rng.zipf(1.5, int(rng.integers(0, 60))) % 90)) for i in range(60)] + [(100, None)]
    got, want = both(small)
    assert got == pytest.approx(want, rel=1e-9, abs=1e-9)
    # A full one errs for a few in a hundred absent n-grams.
    got, want = both([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()])
    off = np.abs(got - want) / np.maximum(1.0, np.abs(want))
    assert np.median(off) < 0.01 and off.max() < 0.25, (np.median(off), off.max())


def test_runs_of_bytes():
    texts = ["", "A b\t\ta", " ", "é\u00a0x\x0b" + "y" * 300, "x" * 128 + " " + "x" * 129, "\n\n", "12345678 123456789 1234567"]
    want = [lm.tokens_of(t) for t in texts]
    run = lm.Run([t.encode() for t in texts])
    flat = [w for t in want for w in t]
    text = np.repeat(np.arange(len(texts)), run.sizes)
    assert run.sizes.tolist() == [len(t) for t in want]
    assert run.words(np.arange(len(flat)), text) == [w.decode() for w in flat]
    assert run.hashes.tolist() == lm.word_hashes(flat).tolist()
    assert len(set(run.hashes.tolist())) == len(set(flat))
    assert len(lm.Run([]).hashes) == 0 and len(lm.gram_keys(lm.Run([]))) == 0
    assert lm.gram_keys(run).tolist() == sorted({*lm.mix(run.hashes).tolist(), *run.pairs().tolist()})


def test_filter_never_too_low():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**64, 20000, dtype=np.uint64)
    counts = rng.zipf(1.7, 20000).clip(1, 10**6)
    f = lm.Filter(0, lm.fill_block(keys & np.uint64((1 << 40) - 1), counts), 1)
    got = f.levels(keys)
    assert (got >= lm.level_of(counts)).all() and (got == lm.level_of(counts)).mean() > 0.9
    absent = f.levels(rng.integers(0, 2**64, 20000, dtype=np.uint64))
    assert (absent > 0).mean() < 0.1


def test_small(spark):
    rows = [(1, "a b a"), (2, None), (3, "A")]
    check(lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect(), brute(rows))
    assert lm.score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    held = [(i, "x") for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    check(lm.score_texts(spark.createDataFrame(held, "doc_id long, text string")).collect(), brute(held))
    for rows in (rows, held, []):
        check(lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), broadcast_bytes=0).collect(), brute(rows))


def test_runs_over_many_batches(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    want = sorted(tuple(r) for r in lm.score_texts(docs).collect())
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = sorted(tuple(r) for r in lm.score_texts(docs, broadcast_bytes=0, part_bytes=lm.BLOCK).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want]) and [r[6] for r in got] == pytest.approx([r[6] for r in want])
