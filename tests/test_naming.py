"""Names: against one pass over all items, across runs, one base that has all of them."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from tapeloom.operators import naming, running


def one_pass(bases, taken):
    taken, out = set(taken), []
    for b in bases:
        name, n = b, 1
        while name in taken:
            name, n = f"{b}_{n}", n + 1
        taken.add(name)
        out.append(name)
    return out


def items(spark, bases, parts=5):
    return spark.createDataFrame(list(enumerate(bases)), "seq long, slug string").repartition(parts)


def clashing(rng, n):
    ends = ["", "", "", "_1", "_2", "_3", "_1_1", "_1_2", "_2_1", "_10", "_01", "_0", "_1_01"]
    return [rng.choice(["a", "b", "", "c_", "_", "x_y"]) + rng.choice(ends) for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_against_one_pass(spark, seed):
    rng = random.Random(seed)
    bases, taken = clashing(rng, rng.choice([3, 30, 300])), clashing(rng, rng.choice([0, 5, 40]))
    existing = spark.createDataFrame([(t,) for t in taken + taken[:3]] + [(None,)], "name string")
    got = naming.allocate(items(spark, bases), existing).orderBy("seq").collect()
    want = one_pass(bases, taken)
    assert [(r.seq, r.slug, r.name) for r in got] == list(zip(range(len(bases)), bases, want))
    assert len(set(want)) == len(want)


def test_contests_against_one_pass():
    """Which numbers are blocked, alone, on many small cases."""
    rng = random.Random(9)
    for _ in range(3000):
        bases = [rng.choice(["a", "a", "a_1", "a_2", "a_1_1", "a_3"]) for _ in range(rng.randrange(1, 9))]
        taken = {rng.choice(["a", "a_1", "a_2", "a_1_1", "a_2_1"]) for _ in range(rng.randrange(3))}
        first = {b: bases.index(b) for b in bases}
        held = {b: [] for b in first}
        for c in first:
            p, _, k = c.rpartition("_")
            if p in first:
                held[p].append((int(k), c, bases[: first[c]].count(p)))
        numbers = {b: [0] * (b in taken) + [int(t.rpartition("_")[2]) for t in taken if t.rpartition("_")[0] == b] for b in first}
        blocked = {}
        for b, n in naming._contests(held, numbers):
            blocked.setdefault(b, set()).add(n)
        got, given = [], {}
        for b in bases:
            n = given.get(b, -1) + 1
            while n in blocked.get(b, ()):
                n += 1
            given[b] = n
            got.append(f"{b}_{n}" if n else b)
        assert got == one_pass(bases, taken), (bases, taken)


def test_odd_items(spark):
    rows = spark.createDataFrame([(1, None), (2, "a"), (3, ""), (4, ""), (2, "a")], "seq long, slug string")
    assert sorted((tuple(r) for r in naming.allocate(rows).collect()), key=str) == sorted([(1, None, None), (2, "a", "a"), (2, "a", "a_1"), (3, "", ""), (4, "", "_1")], key=str)
    assert naming.allocate(rows.limit(0)).count() == 0


def test_one_base_has_all(spark):
    """A million equal names: each task has its share, and all are given out."""
    n = 1_000_000
    rows = spark.range(n).select(F.col("id").alias("seq"), F.lit("talk").alias("slug"))
    existing = spark.createDataFrame([("talk_5",), ("talk_500000",), ("talk",)], "name string")
    got = naming.allocate(rows, existing)
    assert got.where("name is not null").groupBy(F.spark_partition_id()).count().count() > 1
    number = F.coalesce(F.regexp_extract("name", r"_(\d+)$", 1).try_cast("long"), F.lit(0))
    r = got.select("seq", number.alias("k")).agg(F.count_distinct("k").alias("n"), F.max("k").alias("most"), F.min("k").alias("least"), F.sum((F.col("k") == 5).cast("int")).alias("five")).first()
    assert tuple(r) == (n, n + 2, 1, 0)
    assert got.where("seq in (0, 3, 4, 499996, 499997, 499998)").orderBy("seq").select("name").rdd.flatMap(list).collect() == ["talk_1", "talk_4", "talk_6", "talk_499998", "talk_499999", "talk_500001"]


def test_running_sum(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), i, rng.randrange(3)) for i in range(500)]
    got = running.running_sum(spark.createDataFrame(rows, "k string, i long, w long").repartition(7), "k", ["i"], "w").collect()
    want = {}
    for k, i, w in rows:
        want[i] = sum(x[2] for x in rows if x[0] == k and x[1] <= i)
    assert {r.i: r.upto for r in got} == want


def test_runs_share_a_table(spark, tmp_path):
    table = naming.NameTable(spark, str(tmp_path / "names"))
    assert table.last_run() == 0 and table.names().count() == 0
    rng = random.Random(4)
    runs = [clashing(rng, 40) for _ in range(3)]
    want = one_pass([b for r in runs for b in r], ["a"])
    existing = spark.createDataFrame([("a",)], "name string")
    got = []
    for r in runs:
        got += [x.name for x in table.allocate(items(spark, r), existing=existing).orderBy("seq").collect()]
    assert got == want
    assert {(r.run, r["count"]) for r in table.names().groupBy("run").count().collect()} == {(1, 40), (2, 40), (3, 40)}
    assert table.names(2).count() == 80


def test_runs_that_meet(spark, tmp_path, monkeypatch):
    """Another run publishes while this one allocates: it allocates anew."""
    table, other = (naming.NameTable(spark, str(tmp_path / "names")) for _ in range(2))
    allocate, met = naming.allocate, threading.Event()

    def slow(*args):
        found = allocate(*args)
        if not met.is_set():
            met.set()
            other.allocate(items(spark, ["a", "b"]))
        return found

    monkeypatch.setattr(naming, "allocate", slow)
    got = [r.name for r in table.allocate(items(spark, ["a", "a"])).orderBy("seq").collect()]
    assert got == ["a_1", "a_2"] and table.last_run() == 2
    assert sorted(p.name for p in (tmp_path / "names").iterdir()) == ["version=1", "version=2"]
