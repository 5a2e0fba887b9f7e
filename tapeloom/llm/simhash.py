"""Operator 9, SimHash near-duplicates, pairs thinned by pivot distance tables.

Fingerprints link at ``RADIUS`` or fewer differing bits. The Hamming distance to a fixed reference
is off by no more than the distance of two fingerprints, so a pair whose distances to some pivot
differ by more than the radius is no link. Two families of pivots are used:

- unit pivots, the zero word and its 64 one-bit neighbours: the differences of the distances to
  them spell out the bits. Of ``b`` blocks of bits, at most ``RADIUS`` differ in a link, so it
  agrees, at distance difference zero, on all unit pivots of some ``b - RADIUS`` blocks. These
  coordinates are the keys under which fingerprints meet;
- random pivots, whose distances are tabulated once for each fingerprint and go with it: every pair
  that meets is discarded if its largest coordinate difference is over the radius, and only the
  bits of those left are compared. ``pair_counts`` tells how many pairs met, were discarded and verified.

Random pivots alone thin out pairs but yield no keys (distances of 64 random bits have a deviation
of 4, no more than the radius), so all pairs would have to be visited; hence the first family.

Equal fingerprints are one row. Within a key a search from fingerprint to fingerprint emits a
spanning forest, never all pairs. A key with more than ``HOT`` fingerprints is cut into tiles, each
a pair of slices, and the tiles are dealt to many tasks.

Defined results: null, empty and blank texts have the fingerprint zero and are linked like any
other; rows that repeat an id are each returned; a null id is returned and takes the component of its
fingerprint (null if no id is in it); an empty table gives no rows; columns other than the id and
the text are not looked at by ``near_duplicates`` and are kept by ``keep_one``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tapeloom.llm.common import ASCII_LOWER, ship, written
from tapeloom.llm.components import components, with_least

ship(__name__)

SHINGLE = 4
SEED = 42
RADIUS = 4
N_PIVOTS = 24
#: Fingerprints under one key, beyond which it is cut into tiles.
HOT = 20_000


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
    of = xxhash.xxh64_intdigest
    hashes = np.array([of(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())], "<u8")
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 8192):
        total += np.unpackbits(hashes[k : k + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, fp): fp is the fingerprint as a signed 64-bit number."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            fp = np.array([fingerprint_of(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"doc_id {kind}, fp long")


def block_masks(n_blocks: int) -> list[int]:
    edges = [round(64 * i / n_blocks) for i in range(n_blocks + 1)]
    return [((1 << b) - 1) & ~((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def key_masks(n: int, radius: int = RADIUS) -> list[int]:
    """Bits of each key: more blocks the more fingerprints there are, so that a key holds a few."""
    want = max(int(n).bit_length() - 1, 8)
    for n_blocks in range(radius + 2, radius + 7):
        if 64 * (n_blocks - radius) // n_blocks >= want:
            break
    blocks = block_masks(n_blocks)
    return [sum(c) for c in combinations(blocks, n_blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    return np.random.default_rng(20_24).integers(0, 2**64, n, dtype=np.uint64)


def distance_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Distances of each fingerprint to each pivot."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def with_distances(fps: DataFrame) -> DataFrame:
    """The table of distances: ``fp`` and ``d``, its distance to each pivot."""
    return fps.select("fp", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(int(p))))).cast("tinyint") for p in pivots()]).alias("d"))


class Met:
    """Fingerprints that met under keys, their distances, and what became of the pairs."""

    def __init__(self, fps: np.ndarray, table: np.ndarray, radius: int):
        self.fps, self.table, self.radius = fps, table, radius
        self.met = self.discarded = 0

    def near(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that link to ``i``: coordinate by coordinate, then bit by bit."""
        left = others
        for k in range(0, self.table.shape[1], 8):
            # Differences are small, so the largest of eight coordinates at once is cheap.
            left = left[np.abs(self.table[left, k : k + 8] - self.table[i, k : k + 8]).max(1) <= self.radius]
        self.met += len(others)
        self.discarded += len(others) - len(left)
        return left[np.bitwise_count(self.fps[left] ^ self.fps[i]) <= self.radius]

    def pairs(self, begin: np.ndarray) -> list[tuple[int, int]]:
        """Links of the groups of two that begin at the given rows, all at once."""
        far = np.abs(self.table[begin] - self.table[begin + 1]).max(1, initial=0) > self.radius
        self.met += len(begin)
        self.discarded += int(far.sum())
        begin = begin[~far]
        begin = begin[np.bitwise_count(self.fps[begin] ^ self.fps[begin + 1]) <= self.radius]
        return [(i, i + 1) for i in begin.tolist()]

    def forest(self, begin: int, end: int) -> list[tuple[int, int]]:
        """Links that span the components of the distinct fingerprints in these rows."""
        left, out = np.arange(begin, end), []
        queue: list[int] = []
        while len(left):
            if not queue:
                queue.append(int(left[0]))
                left = left[1:]
            i = queue.pop()
            found = self.near(i, left)
            if len(found):
                out += [(i, int(j)) for j in found]
                queue += found.tolist()
                left = left[~np.isin(left, found)]
        return out


def links(fps: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """Links (a, b) that join all fingerprints (``with_distances`` of distinct ones) within ``radius``, transitively.

    Rows with a null link have the numbers ``met`` and ``discarded`` of pairs of a task.
    """
    if "d" not in fps.columns:
        fps = with_distances(fps)
    n = fps.count()
    masks = key_masks(n, radius)
    keyed = fps.select("fp", "d", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("t", "k"))
    crowded = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where(F.col("n") > hot) if n > hot else None
    none = F.lit(0)
    if crowded is not None and (crowded := written(crowded, "crowded")).head(1):
        # Slices s of a crowded key; a fingerprint goes to all tiles (s, other), so that every two of them share one.
        tiles = keyed.join(crowded, ["t", "k"], "left").withColumn("slices", F.coalesce(F.ceil(F.col("n") / hot), F.lit(1)).cast("int"))
        tiles = tiles.withColumn("s", F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int"))
        tiles = tiles.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        tile = F.when(F.col("slices") > 1, F.least("s", "o") * F.col("slices") + F.greatest("s", "o")).otherwise(none)
        keyed = tiles.select("fp", "d", "t", "k", tile.alias("tile"))
    else:
        keyed = keyed.withColumn("tile", none)

    def run(batches):
        import pyarrow as pa

        held: list[tuple[np.ndarray, np.ndarray]] = []
        last = None

        def pairs(parts):
            rows, table = (np.concatenate(p) for p in zip(*parts))
            cut = np.flatnonzero((rows[1:, 1:] != rows[:-1, 1:]).any(1)) + 1
            begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(rows)]])
            met = Met(rows[:, 0].copy().view(np.uint64), table, radius)
            found = met.pairs(begin[end - begin == 2])
            for s, e in zip(begin[end - begin > 2].tolist(), end[end - begin > 2].tolist()):
                found += met.forest(s, e)
            at = np.array(found, np.int64).reshape(-1, 2)
            none = pa.nulls(1, pa.int64())
            links = [pa.concat_arrays([pa.array(rows[at[:, i], 0]), none]) for i in (0, 1)]
            counts = [pa.concat_arrays([pa.nulls(len(at), pa.int64()), pa.array([n], pa.int64())]) for n in (met.met, met.discarded)]
            return pa.RecordBatch.from_arrays([*links, *counts], names=["a", "b", "met", "discarded"])

        for b in batches:
            rows = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("fp", "t", "k", "tile")], 1)
            if not len(rows):
                continue
            table = b.column("d").flatten().to_numpy().reshape(len(rows), -1)
            # The last key of a batch may go on in the next one.
            same = (rows[:, 1:] == rows[-1, 1:]).all(1)
            first = len(rows) - int(np.argmin(same[::-1])) if not same.all() else 0
            if last is not None and (rows[0, 1:] != last).any():
                yield pairs(held)
                held = []
            if first:
                yield pairs([*held, (rows[:first], table[:first])])
                held = []
            held.append((rows[first:].copy(), table[first:].copy()))
            last = rows[-1, 1:].copy()
        if held:
            yield pairs(held)

    dealt = keyed.repartition("t", "k", "tile").sortWithinPartitions("t", "k", "tile")
    return written(dealt.select("fp", "t", "k", "tile", "d").mapInArrow(run, "a long, b long, met long, discarded long"), "met")


def pair_counts(met: DataFrame) -> tuple[int, int, int]:
    """Of what ``links`` gives: pairs that met, those that the pivots discarded, those whose bits were compared."""
    n = met.agg(F.coalesce(F.sum("met"), F.lit(0)), F.coalesce(F.sum("discarded"), F.lit(0))).first()
    return n[0], n[1], n[0] - n[1]


def _classes(rows: DataFrame, radius: int, hot: int) -> DataFrame:
    """Rows (fp, component, component_id) for rows (doc_id, fp): component_id is the component's smallest id."""
    groups = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "groups")
    of = components(links(written(with_distances(groups), "distances"), radius, hot).where("a is not null"))
    named = groups.join(of.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    return written(with_least(named, "component", "first", "component_id").select("fp", "component", "component_id"), "classes")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, hot: int = HOT, shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, fp, component_id): component_id is the smallest id that links reach, the row's own included."""
    rows = written(fingerprints(docs, key, text, shingle), "fingerprints")
    return rows.join(_classes(rows, radius, hot), "fp").select("doc_id", "fp", "component_id")


@F.pandas_udf(LongType())
def _fp(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint_of(t) for t in texts.tolist()], np.uint64).view(np.int64))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, null_ids: bool = False) -> DataFrame:
    """The rows of ``docs`` that stand for their groups: those with the group's smallest id. All columns are kept.

    Of rows that repeat that id the one whose text has the smallest hash stays, then the first as JSON. Rows without an id stay; with ``null_ids`` they belong to groups too: they go where a row with an id is
    in the group, and else one of them stays, chosen in the same way.
    """
    no_id = F.col(f"`{key}`").isNull()
    null_ids = null_ids and bool(docs.where(no_id).select(F.lit(1)).head(1))
    mine = "__id" + "_" * max(len(c) for c in docs.columns)  # longer than any column's name
    if null_ids:
        rows = written(fingerprints(docs, key, text), "fingerprints")
        table = _classes(rows, radius, HOT)
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        nameless = docs.where(no_id).withColumn(mine, _fp(F.col(f"`{text}`")))
        nameless = nameless.join(table.where("component_id is null").select(F.col("fp").alias(mine), F.col("component").alias(f"{mine}_")), mine)
        alone = nameless.groupBy(f"{mine}_").agg(F.min_by(whole, F.struct(F.xxhash64(text), F.to_json(whole))).alias("row")).select("row.*")
        rows = rows.join(table, "fp").select("doc_id", "fp", "component_id")
        docs = docs.where(~no_id)
    else:
        rows = near_duplicates(docs.where(~no_id), key, text, radius)
    same = F.col(f"`{key}`") == F.col(mine)
    # Written, the ids that go have a known size: Spark broadcasts them if they are under its threshold, else the rows are dealt by id.
    losers = written(rows.where("doc_id <> component_id").select(F.col("doc_id").alias(mine)).distinct(), "losers")
    left = docs.join(losers, same, "left_anti")
    again = left.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias(mine)).agg(F.count("*").alias("n")).where("n > 1").select(mine)
    if not again.head(1):
        return left.unionByName(alone) if null_ids else left
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    twice = left.join(again, same, "left_semi").groupBy(F.col(f"`{key}`").alias(mine))
    first = twice.agg(F.min_by(whole, F.struct(F.xxhash64(text), F.to_json(whole))).alias("row")).select("row.*")
    kept = left.join(again, same, "left_anti").unionByName(first)
    return kept.unionByName(alone) if null_ids else kept


def simhash_report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
