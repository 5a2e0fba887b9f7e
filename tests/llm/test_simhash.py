"""Operator 9 against all pairs."""

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tapeloom.llm import components, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fp(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(low)
    if not w:
        return 0
    sh = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius=4):
    fps = np.array(fps, np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius).tolist():
            root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(d, least.get(find(i), d))
    return [least[find(i)] for i in range(len(ids))]


def test_documents(spark, sf_dir):
    odd = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, " \n"), (10**6 + 3, "A b"), (10**6 + 4, "a B"), (10**6 + 5, "É x É x É"), (10**6 + 5, "É x É x É"), (10**6 + 6, "w " * 20000), (10**6 + 7, "W " * 90)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string")).selectExpr("*", "1 fp", "2 n", "3 first")
    rows = docs.collect()
    fps = [brute_fp(r.text) for r in rows]
    want = sorted(zip([r.doc_id for r in rows], [f"{f:016x}" for f in fps], brute_components([r.doc_id for r in rows], fps)))
    assert sorted(tuple(r) for r in simhash.simhash_report(docs).collect()) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r[2] for r in want})


def test_kept_row_of_a_repeated_id(spark):
    rows = [(1, "a b c d e f", 5, 1), (1, "a b c d e f", 4, 2), (2, "A b c d e f", 3, 3), (None, "a b c d e f", 2, 4), (9, "quite another text of a few words", 1, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id int, `component_id` int").repartition(3)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)


def test_null_ids_belong_to_groups(spark):
    same, other, third = "a b c d e f", "quite another text of a few words", "and a third one that is not like them"
    rows = [(None, same, 1), (5, same.upper(), 2), (7, same, 3), (None, other, 4), (None, other.upper(), 5), (None, other, 6), (8, third, 7), (8, third, 8), (None, None, 9), (None, "", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `component` int").repartition(3)
    for one in (docs, docs.where("component not in (7, 8)"), docs.where("doc_id is not null"), docs.where("doc_id is null")):
        given = {r.component for r in one.collect()}
        kept = corpus_pipeline.simhash_dedup(spark, one, "")
        assert kept.columns == docs.columns
        got = sorted(r.component for r in kept.collect())
        groups = [{1, 2, 3}, {4, 5, 6}, {7, 8}, {9, 10}]
        assert [len(g & set(got)) for g in groups] == [min(1, len(g & given)) for g in groups] and len(got) == len(set(got))
        assert (2 in got) == (2 in given)


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**64, 40, dtype=np.uint64)
    out = [0, 2**64 - 1]
    for i in range(n):
        x = int(centres[int(rng.integers(0, 40) ** 2 // 40)])
        for b in rng.integers(0, 64, int(rng.integers(0, 9))):
            x ^= 1 << int(b)
        out.append(x)
    return sorted(set(out))


def test_links_of_clusters_also_when_tiled(spark):
    fps = clustered(1500, 3)
    want = brute_components(fps, fps)
    df = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long")
    for hot in (20_000, 30):
        met = simhash.links(df, hot=hot)
        n, discarded, verified = simhash.pair_counts(met)
        # Every pair that meets goes by the pivots, which spare nearly all of the unrelated ones.
        assert n == discarded + verified and discarded > n / 2
        got = {r.node % 2**64: r.component for r in components.components(met.where("a is not null")).collect()}
        class_of = {}
        for f, c in zip(fps, want):
            class_of.setdefault(c, []).append(f)
        for members in class_of.values():
            assert len({got.get(f, f) for f in members}) == 1
        assert len({got.get(f, f) for f in fps}) == len(class_of)


def test_keys_lose_no_link():
    rng = np.random.default_rng(0)
    for n in (1, 10**6, 10**8, 10**10, 10**13):
        masks = simhash.key_masks(n)
        for _ in range(200):
            flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(m & flips == 0 for m in masks)


def test_pivot_bound():
    fps = np.random.default_rng(0).integers(0, 2**64, 200, dtype=np.uint64)
    table = simhash.distance_table(fps, simhash.pivots()).astype(int)
    far = np.abs(table[:, None] - table[None]).max(2)
    assert (far <= np.bitwise_count(fps[:, None] ^ fps[None])).all()


def test_distances_are_tabulated(spark):
    fps = np.random.default_rng(0).integers(0, 2**64, 50, dtype=np.uint64)
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    got = {r.fp: r.d for r in simhash.with_distances(df).collect()}
    want = simhash.distance_table(fps, simhash.pivots())
    assert got == {int(f): d.tolist() for f, d in zip(fps.view(np.int64), want)}


def test_a_star_with_very_many_points(spark):
    rows = [(i, 7) for i in range(10, 20_000)] + [(5, 7), (3, 2)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**{i: 5 for i in range(10, 20_000)}, 5: 5, 7: 5, 2: 2, 3: 2}
    dealt = components.with_least(spark.createDataFrame([(1, i) for i in range(10_000)], "u long, v long"), "u", "v", "m").collect()
    assert len(dealt) == 10_000 and {r.m for r in dealt} == {0}


def test_components_of_long_paths(spark):
    rows = [(i, i + 1) for i in range(200)] + [(1000, 500), (700, 1000), (5000, 5000)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 700: 500, 1000: 500}


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_report(none).count() == 0
    assert simhash.keep_one(none).count() == 0
    one = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert simhash.simhash_report(one).count() == 2 and simhash.keep_one(one).count() == 2
