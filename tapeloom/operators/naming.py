"""Names that no other item has. name, name_1, name_2, ...: the first that is free, item after item.

Numbers of a base are given out in rising order, so that the r-th item of a base gets the r-th number that
nothing blocks for it. What blocks one is a name that is taken before the run, or an item whose own base is
that name, if it comes before the base has got so far. The second is decided among bases, not items: of each
base that ends in a number, all that counts is how many items of the base without it come before its first
one. So items are only ranked and joined to the gaps between blocked numbers, both by running sums that no
single task has to see whole: a million equal names are dealt to many tasks. Distinct bases that are equal
without trailing numbers pass through one task.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.running import running_sum
from tapeloom.shipping import ship
from tapeloom.sources import versions
from tapeloom.work import written

ship(__name__)

ROOT = r"(_\d+)+$"
#: A name that a base gives out: the base and a number, which has no leading zero. Longer numbers are never reached.
NUMBERED = r"(?s)^(.*)_([1-9][0-9]{0,17})$"
BLOCKED = "base string, number long"


def _parent(name: Column) -> Column:
    return F.regexp_extract(name, NUMBERED, 1)


def _number(name: Column) -> Column:
    return F.regexp_extract(name, NUMBERED, 2).cast("long")


def _contests(bases: dict[str, list[tuple[int, str, int]]], taken: dict[str, list[int]]) -> Iterator[tuple[str, int]]:
    """Blocked numbers of bases that are equal without trailing numbers.

    ``bases``: of each its children, (number, base, items of this base before the child's first one);
    ``taken``: of each the numbers of names that are taken.
    """
    # A base before those that extend it: whether it has its own name is then known.
    for base in sorted(bases, key=len):
        have = set(taken.get(base, ()))
        blocked = sorted(have)
        for number, child, earlier in sorted(bases[base]):
            if number in have:
                continue
            # Items that have been given smaller numbers before the base gets to this one.
            if earlier <= number - bisect.bisect_left(blocked, number):
                bisect.insort(blocked, number)
                have.add(number)
            else:
                taken.setdefault(child, []).append(0)
        yield from ((base, n) for n in blocked)


def allocate(items: DataFrame, existing: DataFrame | None = None, order: str = "seq", base: str = "slug") -> DataFrame:
    """Rows of (order, base) with ``name``; ``existing`` has a column ``name`` of names that are taken.

    Items are taken by ``order``, of equal ones by base. An item without a base has no name.
    """
    # Written once: what names come from is not worked out anew for each use below.
    given = written(items.select(F.col(order).cast("long").alias("at"), F.col(base).alias("base")))
    rows = given.where("base is not null")
    first = rows.groupBy("base").agg(F.min("at").alias("at"))
    numbered = first.where(F.col("base").rlike(NUMBERED)).select(_parent(F.col("base")).alias("base"), "at", F.col("base").alias("child"))
    # Only bases that have items lose numbers to children.
    children = numbered.join(first.select("base"), "base", "left_semi")

    # Items rank among those of their base; children learn how many come before them.
    none = F.lit(None).cast("string")
    both = rows.select("base", "at", none.alias("child"), F.lit(1).cast("long").alias("one")).unionByName(children.select("base", "at", "child", F.lit(0).cast("long").alias("one")))
    ranked = running_sum(both, "base", ["at", "child"], "one", "rank")
    children = ranked.where("child is not null").select("base", "child", F.col("rank").alias("earlier"))

    taken = None
    if existing is not None:
        names = existing.select("name").where("name is not null").distinct()
        numbers = names.where(F.col("name").rlike(NUMBERED)).select(_parent(F.col("name")).alias("base"), _number(F.col("name")).alias("number"))
        taken = names.select(F.col("name").alias("base"), F.lit(0).cast("long").alias("number")).unionByName(numbers).join(first.select("base"), "base", "left_semi")

    # Kinds of rows of a base: itself, a child, a number that is taken.
    facts = first.select("base", none.alias("child"), F.lit(None).cast("long").alias("n")).unionByName(children.select("base", "child", F.col("earlier").alias("n")))
    if taken is not None:
        facts = facts.unionByName(taken.select("base", F.lit("").alias("child"), F.col("number").alias("n")))
    facts = facts.withColumn("root", F.regexp_replace("base", ROOT, "")).repartition("root").sortWithinPartitions("root")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        root, bases, have = None, {}, {}
        for batch in batches:
            out = []
            for b, child, n, r in zip(batch["base"], batch["child"], batch["n"], batch["root"]):
                if r != root:
                    out += _contests(bases, have)
                    root, bases, have = r, {}, {}
                if child is None:
                    bases.setdefault(b, [])
                elif child == "":
                    have.setdefault(b, []).append(int(n))
                else:
                    bases.setdefault(b, []).append((int(re.match(NUMBERED, child)[2]), child, int(n)))
            yield pd.DataFrame(out, columns=["base", "number"])
        yield pd.DataFrame(list(_contests(bases, have)), columns=["base", "number"])

    blocked = facts.mapInPandas(run, BLOCKED)
    return _numbered(given, ranked, blocked, order, base)


def _numbered(given: DataFrame, ranked: DataFrame, blocked: DataFrame, order: str, base: str) -> DataFrame:
    """The r-th item of a base gets r - 1 and as many more as blocked numbers lie below what it gets."""
    free = running_sum(blocked.withColumn("one", F.lit(1).cast("long")), "base", ["number"], "one", "nth")
    # A blocked number counts for all items from that place on at which it would be next.
    gaps = free.select("base", (F.col("number") - F.col("nth") + 1).alias("place"), F.lit(0).alias("kind"), F.lit(1).cast("long").alias("one"), F.lit(None).cast("long").alias("at"))
    items = ranked.where("child is null").select("base", (F.col("rank") - 1).alias("place"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("one"), "at")
    placed = running_sum(gaps.unionByName(items), "base", ["place", "kind"], "one", "skipped").where("kind = 1")
    number = F.col("place") + F.col("skipped")
    name = F.when(number == 0, F.col("base")).otherwise(F.concat("base", F.lit("_"), number.cast("string")))
    named = placed.select(F.col("at").alias(order), F.col("base").alias(base), name.alias("name"))
    return named.unionByName(given.where("base is null").select(F.col("at").alias(order), F.col("base").alias(base), F.lit(None).cast("string").alias("name")))


class NameTable:
    """Names given out by all runs so far, a version for each run, in a folder that all runs share.

    A run reads the versions that are there, allocates, and publishes its names as the next version. If another
    run has published that version meanwhile, it allocates anew: so no name is ever given out twice.
    """

    SCHEMA = "`order` long, base string, name string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def last_run(self) -> int:
        return versions.last(self.path)

    def names(self, upto: int | None = None) -> DataFrame:
        """All names up to a run, with the ``run`` that gave them out."""
        n = self.last_run() if upto is None else upto
        if not n:
            return self.spark.createDataFrame([], f"{self.SCHEMA}, run long")
        runs = [self.spark.read.schema(self.SCHEMA).parquet(p).withColumn("run", F.lit(k + 1).cast("long")) for k, p in enumerate(versions.files_of(self.path, n))]
        return functools.reduce(DataFrame.unionByName, runs)

    def allocate(self, items: DataFrame, order: str = "seq", base: str = "slug", existing: DataFrame | None = None, tries: int = 10) -> DataFrame:
        """As ``naming.allocate``, and taken for good when this returns. ``existing``: further names that are taken, say of files."""
        for _ in range(tries):
            run = self.last_run()
            taken = self.names(run).select("name")
            found = allocate(items, taken if existing is None else taken.unionByName(existing.select("name")), order, base)
            new = versions.stage(found.select(F.col(order).alias("order"), F.col(base).alias("base"), "name"), self.path)
            if versions.publish(self.path, new, run + 1):
                mine = self.spark.read.schema(self.SCHEMA).parquet(versions.files_of(self.path, run + 1)[-1])
                return mine.select(F.col("order").alias(order), F.col("base").alias(base), "name")
            versions.discard(self.path, new)
        raise RuntimeError(f"other runs took the next version {tries} times")
