"""Folds over long arrays: the values of a plain loop, in time that grows with the length alone."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import arrays
from tapeloom.operators import clean, merge
from tapeloom.schema import SEGMENT


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 128, 4096, 4097, 4100, 20_000])
def test_running(spark, n):
    rng = random.Random(n)
    values = [rng.randrange(100) for _ in range(n)]
    df = spark.createDataFrame([(values,)], "x array<int>")
    got = df.select(arrays.running(F.col("x"), lambda a, b: a + b).alias("s"), arrays.running(F.col("x"), F.greatest).alias("m")).first()
    assert got.s == list(itertools.accumulate(values)) and got.m == list(itertools.accumulate(values, max))


def test_scan(spark):
    for n in (0, 1, 255, 256, 257, 3000):
        df = spark.createDataFrame([(list(range(n)),)], "x array<int>")
        step = lambda state, x: F.struct(((state * 3 + x) % 1000).alias("state"), F.concat_ws("-", state, x).alias("given"))
        got = df.select(arrays.scan(F.col("x"), F.lit(7), "int", "string", step).alias("y")).first().y
        state, want = 7, []
        for x in range(n):
            want.append(f"{state}-{x}")
            state = (state * 3 + x) % 1000
        assert got == want


def cleaned(t):
    out, body = [], None
    for line in t.split("\n"):
        goes_on = line.startswith("- ") or body is not None and body.endswith(",")
        body = line.replace("- ", "", 1) if goes_on else line
        out.append(body + " ")
    return "".join(out)


def seconds(f):
    began = time.perf_counter()
    f()
    return time.perf_counter() - began


def test_lines(spark):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice(["- ", "a,", "b,- ", "- c,- ", "", ",", "- ,", "x- y,", "z"]) for _ in range(rng.randrange(300))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert {r.i: r.c for r in df.select("i", clean.clean_lines(F.col("t")).alias("c")).collect()} == {i: cleaned(t) for i, t in enumerate(texts)}


def test_many_lines_in_one_text(spark):
    def took(n):
        t = "\n".join(("- abc, x,", "foo- ,", "bar,- ", "hello")[i % 4] for i in range(n))
        df = spark.createDataFrame([(t,)], "t string").cache()
        assert df.select(clean.clean_lines(F.col("t"))).first()[0] == cleaned(t)
        return min(seconds(df.select(clean.clean_lines(F.col("t"))).collect) for _ in range(2))

    half, whole = took(100_000), took(200_000)
    assert whole < 30 and whole < 2 * half + 3


def test_many_segments_in_one_transcript(spark):
    def took(n):
        df = spark.createDataFrame([(1, s, float(s), s + 1.0, "one two. three" if s % 3 else "four! five.", -0.5) for s in range(n)], SEGMENT).cache()
        assert df.count() == n
        return seconds(merge.merge_segments(df).count)

    half, whole = took(15_000), took(30_000)
    assert whole < 40 and whole < 2 * half + 4
