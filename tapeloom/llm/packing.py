"""Operator 3, best-fit packing by exact-complement hashing.

Texts become pieces of at most ``size`` tokens. The plan is made on the histogram of piece lengths,
at most ``size`` numbers whatever the input: for the longest length left, its gap is looked up among
the single lengths, then the sums of pairs, then of triples; a combination that fills the gap exactly
is consumed as often as the counts allow. What is left goes best-fit. Pieces then take their places
by their rank within their length, ranked in salted groups so that a frequent length is dealt to
many tasks.

Defined results: null text is empty and gives one piece, the end token; ids, null or repeated, are
carried as they are and each row is packed; an empty table gives no pieces; columns other than the
id and the text are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import ship, written
from tapeloom.llm.tokens import END, encoder

ship(__name__)

SIZE = 1024
#: Pieces ranked in one group, about.
GROUP = 1_000


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """Start and length of each piece of ``n`` tokens: only the first may be shorter than ``size``."""
    first = n % size or min(n, size)
    return [(0, first), *((s, size) for s in range(first, n, size))]


def pieces(docs: DataFrame, size: int = SIZE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): each text encoded once."""

    def run(batches):
        import pyarrow as pa

        e = encoder()
        for b in batches:
            take, rows = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                ids = np.append(e.ids(t or ""), np.uint32(END)).astype("<u4")
                for p, (s, n) in enumerate(cut(len(ids), size)):
                    take.append(i)
                    rows.append((p, s, n, zlib.crc32(ids[s : s + n].tobytes())))
            cols = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(take, pa.int64())), *cols], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Complements:
    """Which available lengths add up to a gap: by hash of singles, pairs, then triples."""

    def __init__(self, counts: dict[int, int]):
        self.counts = dict(counts)
        self.lengths = sorted(counts)

    def take(self, combo: tuple[int, ...], times: int) -> None:
        for n in combo:
            self.counts[n] -= times
            if not self.counts[n]:
                del self.counts[n]
                self.lengths.pop(bisect_left(self.lengths, n))

    def give(self, n: int) -> None:
        """One piece back."""
        if n not in self.counts:
            insort(self.lengths, n)
        self.counts[n] = self.counts.get(n, 0) + 1

    def times(self, combo: tuple[int, ...]) -> int:
        return min(self.counts.get(n, 0) // combo.count(n) for n in combo)

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if gap in self.counts else None

    def pairs(self, gap: int, most: int | None = None) -> Iterator[tuple[int, ...]]:
        """The most unequal pair first: it keeps middling lengths for later."""
        for a in reversed(self.lengths[: bisect_left(self.lengths, gap)]):
            if 2 * a < gap:
                return
            if (most is None or a <= most) and gap - a in self.counts and (2 * a != gap or self.counts[a] > 1):
                yield (a, gap - a)

    def pair(self, gap: int) -> tuple[int, ...] | None:
        return next(self.pairs(gap), None)

    def triple(self, gap: int) -> tuple[int, ...] | None:
        for a in reversed(self.lengths[: bisect_left(self.lengths, gap)]):
            if 3 * a < gap:
                return None
            for rest in self.pairs(gap - a, most=a):
                if self.times((a, *rest)):
                    return (a, *rest)
        return None


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths in order, how many of them): the fewest over combinations of at most 3, 2, 1 or 0 lengths.

    Where short pieces are scarce, filling some gaps exactly can leave middling pieces alone.
    """
    return min((plan_to(counts, size, depth) for depth in (3, 2, 1, 0)), key=lambda p: sum(times for _, times in p))


def plan_to(counts: dict[int, int], size: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """The plan with combinations of at most ``depth`` lengths. Each step uses up a length or a kind of open sequence."""
    left = Complements({n: c for n, c in counts.items() if c})
    done: list[tuple[tuple[int, ...], int]] = []
    rest: dict[int, int] = {}
    while left.lengths:
        longest = left.lengths[-1]
        gap = size - longest
        if gap == 0:
            done.append(((longest,), left.counts[longest]))
            left.take((longest,), left.counts[longest])
            continue
        # The longest piece is in use while the gap beside it is looked up.
        left.take((longest,), 1)
        combo = next((c for look in (left.single, left.pair, left.triple)[:depth] if (c := look(gap))), None)
        left.give(longest)
        if combo:
            found = (longest, *combo)
            times = left.times(found)
            done.append((found, times))
            left.take(found, times)
        else:
            rest[longest] = rest.get(longest, 0) + left.counts[longest]
            left.take((longest,), left.counts[longest])
    return done + best_fit(rest, size)


def best_fit(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing, many equal steps at once."""
    open_at: dict[int, list[list]] = {}  # gap: [lengths, how many]
    gaps: list[int] = []

    def put(gap: int, combo: tuple[int, ...], times: int) -> None:
        if gap not in open_at:
            open_at[gap] = []
            insort(gaps, gap)
        open_at[gap].append([combo, times])

    for n in sorted(counts, reverse=True):
        todo = counts[n]
        while todo:
            k = bisect_left(gaps, n)
            if k == len(gaps):
                per = size // n
                full, more = divmod(todo, per)
                if full:
                    put(size - per * n, (n,) * per, full)
                if more:
                    put(size - more * n, (n,) * more, 1)
                break
            gap = gaps[k]
            combo, have = open_at[gap][-1]
            used = min(have, todo)
            if used == have:
                open_at[gap].pop()
                if not open_at[gap]:
                    del open_at[gap]
                    gaps.pop(k)
            else:
                open_at[gap][-1][1] -= used
            put(gap - n, (*combo, n), used)
            todo -= used
    return [(combo, times) for group in open_at.values() for combo, times in group]


def places(sequences: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, sequence of the first rank, step of the sequence for each rank, offset), by length and rank."""
    rank: dict[int, int] = {}
    rows, number = [], 0
    for combo, times in sequences:
        at = 0
        for n in combo:
            rows.append((n, rank.get(n, 0), number, at))
            rank[n] = rank.get(n, 0) + times
            at += n
        number += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, size: int = SIZE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece: where it lies in which sequence."""
    cuts = written(pieces(docs, size, key, text), "pieces")
    counts = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``size`` rows
    table = places(plan(counts, size))
    salts = {n: -(-c // GROUP) for n, c in counts.items()}
    most = max(salts.values(), default=1)
    # All that tells pieces apart, as very many may have one id, or none.
    of = F.xxhash64("doc_id", "piece", "start", "ids_crc32")
    hashed = F.pmod(of, F.lit(most))
    if most > 1:
        per = F.create_map(*[F.lit(x) for n, s in salts.items() if s > 1 for x in (n, s)])
        hashed = F.pmod(of, F.coalesce(F.try_element_at(per, F.col("length")), F.lit(1)))
    salted = cuts.withColumn("salt", hashed)
    # Ranks: within (length, salt), after all of the salts before it.
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = groups.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1)
    ranked = ranked.join(before, ["length", "salt"]).withColumn("rank", F.col("r") + F.col("before"))

    def place(batches):
        import pyarrow as pa

        keys = table[:, 0] * 2**40 + table[:, 1]
        for b in batches:
            n = b.column("length").to_numpy()
            r = b.column("rank").to_numpy()
            at = np.searchsorted(keys, n * 2**40 + r, side="right") - 1
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(table[at, 2] + r - table[at, 1]), pa.array(table[at, 3])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = cuts.schema["doc_id"].dataType.simpleString()
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
