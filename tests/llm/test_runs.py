"""Operator 13 against brute force."""

import hashlib
import random
import time
import zlib

from tapeloom.llm import queries, runs
from tapeloom.llm.common import words_of


def smallest_period(w):
    border, k = [0] * len(w), 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = border[k - 1]
        k += w[i] == w[k]
        border[i] = k
    return len(w) - border[-1]


def brute(w, least_words=24, least_periods=3):
    out = set()
    for q in range(1, len(w) // least_periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least_words, least_periods * q) and smallest_period(w[i : i + length]) == q:
                out.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng):
    n, k = rng.choice([0, 1, 5, 30, 90, 200]), rng.choice([1, 2, 3, 50])
    w = [b"%d" % rng.randrange(k) for _ in range(n)]
    for _ in range(rng.choice([0, 1, 2, 3]) if n else 0):
        a = rng.randrange(n)
        p, end = rng.randrange(1, max(2, (n - a) // 2 + 1)), rng.randrange(a, n + 1)
        for i in range(a, end):
            w[i] = w[a + (i - a) % p]
    return w


def test_runs_of_groups():
    rng = random.Random(5)
    for _ in range(300):
        texts = [some_words(rng) for _ in range(rng.choice([1, 3, 8]))]
        least = rng.choice([(24, 3), (4, 2), (6, 3)])
        assert runs._of_group(texts, *least) == [brute(w, *least) for w in texts]


def test_branching_repeats_are_all_squares_that_end():
    import numpy as np

    rng = random.Random(6)
    for _ in range(100):
        s = [rng.randrange(2) for _ in range(rng.randrange(1, 40))] + [9]
        want = {(i, q) for i in range(len(s)) for q in range(1, len(s)) if i + 2 * q < len(s) and s[i : i + q] == s[i + q : i + 2 * q] and s[i + q] != s[i + 2 * q]}
        start, q = runs.branching_repeats(np.array(s))
        assert set(zip(start.tolist(), q.tolist())) == want


def digest(doc_id, text):
    w = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = brute(w)
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    first = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(found), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(digest(*r) for r in rows)
    got = sorted(tuple(r) for r in queries.op13_periodic_runs(spark, small_dir).collect())
    assert got == want and any(r[1] > 1 for r in got)


def test_odd_rows(spark):
    cycle = " ".join(f"w{i % 40} \t\n" for i in range(500))
    rows = [(None, "a " * 50), (1, None), (2, ""), (3, " \t\x0b\x0c\r\n "), (4, "x " * 30), (4, "x " * 30), (5, cycle + "é" + cycle), (-7, "\x1f  " * 30), (2**63 - 1, "b c " * 13)]
    rows += [(i, "one two three " * 20 + "x y " * 30) for i in range(100, 160)]
    odd = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, runs int, best string")
    got = sorted((tuple(r) for r in runs.runs_report(odd).collect()), key=str)
    assert got == sorted((digest(*r) for r in rows), key=str)
    assert runs.runs_report(odd.limit(0)).count() == 0


def test_long_texts(spark):
    """One long run, and a text of a million words, in seconds."""
    rng = random.Random(1)
    texts = ["a " * 300_000, " ".join(str(rng.randrange(3)) for _ in range(300_000)), " ".join(str(rng.randrange(50_000)) for _ in range(1_000_000))]
    df = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    began = time.perf_counter()
    got = {r.doc_id: r for r in runs.find_runs(df).collect()}
    assert time.perf_counter() - began < 60
    assert [tuple(r) for r in got[1].runs] == [(0, 300_000, 1)] and got[1].collapsed == "a" and not got[3].runs
    assert got[3].collapsed == texts[2]
