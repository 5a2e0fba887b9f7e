"""M1 in chunks: the rows of M1 in one row, whatever the chunk."""

import random

import pytest

from tapeloom.operators import merge
from tapeloom.schema import SEGMENT

PARTS = ["one ", "two. ", "three! ", 'say "', "four", " 7.", "\n", "co-", "x.com", ".", "Five? "]


def transcripts():
    rng = random.Random(11)
    rows = []
    for i in range(12):
        few = rng.choice([PARTS, PARTS[:1] + PARTS[4:5], PARTS[:4], ['"', "a ", "b. "]])  # some hardly end a sentence
        seqs = sorted(rng.sample(range(60), 40)) if i % 3 == 0 else range(rng.choice([1, 8, 40]))
        rows += [(i, s, float(s), s + 1.0, "".join(rng.choice(few) for _ in range(rng.randrange(6))), -rng.random()) for s in seqs]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def whole(spark):
    df = spark.createDataFrame(transcripts(), SEGMENT).repartition(3)
    return df, sorted(tuple(r) for r in merge.merge_segments(df).collect())


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_same_rows(whole, chunk):
    df, want = whole
    assert len(want) > 300
    assert sorted(tuple(r) for r in merge.merge_segments(df, chunk=chunk).collect()) == want


def test_nothing(spark):
    assert merge.merge_segments(spark.createDataFrame([], SEGMENT), chunk=3).count() == 0
