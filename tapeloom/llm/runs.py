"""Operator 13, periodic runs: stretches of words that repeat with a period, by a suffix tree of each text.

The tree's nodes are the intervals of equal prefixes in the sorted suffixes. At a node of depth ``q`` each
leaf of all children but the largest is looked at (so that a leaf is met at most log n times): where the
leaf ``q`` words before or after it is below the same node, but in another child, a square of period ``q``
ends that the next word does not go on with. Such a branching repeat is rotated to the left as far as words
agree; repeats that end at one place with multiples of one period merge into one maximal run.

Texts of a group of about ``GROUP`` words share one tree: each ends with a symbol of its own and no two
share a symbol, so suffixes of different texts part at the root.

Defined results: null or empty text has no words and no runs; ids, null or repeated, are carried as they
are, and of those null none is rewritten; equal texts have equal runs, ties between runs go to the smaller
start, then period; an empty table gives no rows; columns other than the id and the text are not looked at.
A text is held whole in one task, with about 100 bytes and 4 for each doubling of its longest repeat a word.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import ship, words_of

ship(__name__)

#: Words that share a tree, if no single text has more.
GROUP = 1 << 18
#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
RUNS = "array<struct<start:long,length:long,period:long>>"


def _sorted_suffixes(s: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and for each k the ranks by the first 2^k symbols. Only suffixes that share a rank are sorted again."""
    n = len(s)
    bits = n.bit_length()
    places = np.arange(n)

    def by(key: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if 3 * bits < 64:  # sorting the values themselves, place included, is much faster
            packed = np.sort(key << bits | i)
            return packed >> bits, packed & ((1 << bits) - 1)
        order = np.argsort(key, kind="stable")
        return key[order], i[order]

    def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.empty(len(key), bool)
        first[:1] = True
        np.not_equal(key[1:], key[:-1], out=first[1:])
        alone = first.copy()
        alone[:-1] &= first[1:]
        return np.maximum.accumulate(np.where(first, places[: len(key)], 0)), ~alone

    key, order = by(s.astype(np.int64), places)
    heads, shared = grouped(key)
    rank = np.empty(n, np.int32)
    rank[order] = heads
    levels, slots, h = [rank], np.flatnonzero(shared), 1
    while len(slots):
        i = order[slots]
        key, i = by(rank[i].astype(np.int64) << bits | rank[i + h], i)
        order[slots] = i
        heads, shared = grouped(key)
        rank = rank.copy()
        rank[i] = slots[heads]
        levels.append(rank)
        slots, h = slots[shared], 2 * h
    return order, levels


def _common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Symbols that each sorted suffix shares with the one before it."""
    lcp = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    same = []  # by level, those that agree in the first 2^k symbols
    for rank in levels:
        at = at[rank[order[at]] == rank[order[at - 1]]]
        if not len(at):
            break
        same.append(at)
    for k in range(len(same) - 1, -1, -1):
        if k + 1 < len(same):
            at, rank = same[k + 1], levels[k]
            upto = lcp[at]
            lcp[at] = upto + ((rank[order[at] + upto] == rank[order[at - 1] + upto]).astype(np.int64) << k)
        begins = same[k] if k + 1 == len(same) else same[k][lcp[same[k]] == 0]
        lcp[begins] = 1 << k
    return lcp


def _nodes(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inner nodes below the root: depth, first and last slot; and the node at which each slot parts from the one before it (-1: the root)."""
    depth, first, last, parts = [], [], [], []
    open_depth, open_node = [0], [-1]
    for slot, d in enumerate(lcp.tolist()):
        start = slot - 1
        while d < open_depth[-1]:
            open_depth.pop()
            node = open_node.pop()
            last[node] = slot - 1
            start = first[node]
        if d > open_depth[-1]:
            open_depth.append(d)
            open_node.append(len(depth))
            depth.append(d)
            first.append(start)
            last.append(0)
        parts.append(open_node[-1])
    for node in open_node[1:]:
        last[node] = len(parts) - 1
    return tuple(np.array(x, np.int64) for x in (depth, first, last, parts))


def _smaller_leaves(first: np.ndarray, last: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, slot) of the leaves of all children but one largest of each node."""
    cuts = np.flatnonzero(parts >= 0)
    n = len(first)
    # A child begins at its node's first slot or at a cut, and ends before the node's next cut.
    node = np.concatenate([np.arange(n), parts[cuts]])
    begin = np.concatenate([first, cuts])
    order = np.lexsort((begin, node))
    node, begin = node[order], begin[order]
    follows = np.append(node[1:] == node[:-1], False)
    size = np.where(follows, np.append(begin[1:], 0), last[node] + 1) - begin
    heads = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    largest = np.maximum.reduceat(size, heads)[node]
    among = np.flatnonzero(size == largest)
    rest = np.ones(len(size), bool)
    rest[among[np.append(True, node[among][1:] != node[among][:-1])]] = False
    node, begin, size = node[rest], begin[rest], size[rest]
    before = np.cumsum(size) - size
    return np.repeat(node, size), np.arange(int(size.sum())) - np.repeat(before - begin, size)


def branching_repeats(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, q): the squares s[start:start + 2q] that the symbol after them does not go on with."""
    order, levels = _sorted_suffixes(s)
    depth, first, last, parts = _nodes(_common_prefixes(order, levels))
    if not len(depth):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    node, slot = _smaller_leaves(first, last, parts)
    rank, leaf, q, low, high = levels[-1], order[slot], depth[node], first[node], last[node]
    starts, periods = [], []
    for begin, other in ((leaf, leaf + q), (leaf - q, leaf - q)):
        inside = np.flatnonzero((other >= 0) & (other < len(s)))
        r = rank[other[inside]]
        inside = inside[(r >= low[inside]) & (r <= high[inside])]
        begin, period = begin[inside], q[inside]
        ends = s[begin + period] != s[begin + 2 * period]
        starts.append(begin[ends])
        periods.append(period[ends])
    both = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)]), axis=1) if any(map(len, starts)) else np.empty((2, 0), np.int64)
    return both[0], both[1]


def _rotations(s: np.ndarray, start: int, q: int) -> int:
    """How far a square may move to the left: blocks of growing size are compared."""
    at, block = start, 64
    while at > 0:
        low = max(0, at - block)
        differ = np.flatnonzero(s[low:at] != s[low + q : at + q])
        if len(differ):
            return start - (low + int(differ[-1]) + 1)
        at, block = low, 2 * block
    return start


def maximal_runs(s: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal runs of symbols that are long enough, by end, then period."""
    start, q = branching_repeats(s)
    needs = np.maximum(least_words, least_periods * q) - 2 * q
    may = needs <= start
    start, q, needs = start[may], q[may], needs[may]
    # The farthest and the nearest symbol that a run must also hold, before all between.
    for farthest in (True, False):
        back = needs if farthest else np.minimum(needs, 1)
        at = start - back
        may = (back <= 0) | (s[at] == s[at + q])
        start, q, needs = start[may], q[may], needs[may]
    runs: list[tuple[int, int, int]] = []
    here, end = [], -1
    order = np.lexsort((q, start + 2 * q))
    for i, p, more in zip(start[order].tolist(), q[order].tolist(), needs[order].tolist()):
        if i + 2 * p != end:
            here, end = [], i + 2 * p
        # The same run, found by a multiple of its period.
        if any(p % period == 0 and i >= begin for begin, period in here):
            continue
        turned = _rotations(s, i, p)
        if turned >= more:
            here.append((i - turned, p))
            runs.append((i - turned, 2 * p + turned, p))
    return runs


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def _of_group(texts: list[list[bytes]], least_words: int, least_periods: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, from 0 in each, by start, then period."""
    symbols: list[int] = []
    begins, ends, n = [], [], 0
    for words in texts:
        own: dict[bytes, int] = {}
        begins.append(len(symbols))
        symbols += [own.setdefault(w, n + len(own)) for w in words]
        n += len(own)
        symbols.append(n)
        n += 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = maximal_runs(np.array(symbols, np.int64), least_words, least_periods)
    of = np.searchsorted(np.array(begins), np.array([r[0] for r in found], np.int64), side="right") - 1
    for k, (start, length, period) in zip(of.tolist(), found):
        out[k].append((start - begins[k], length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def find_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_words, runs, collapsed): ``runs`` by start, then period, in words from 0; ``collapsed`` is the text with each run cut to its first period."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            ids, words, held, first = b.column(0), [], 0, 0
            for row, text in enumerate(b.column(1)):
                words.append(words_of(text.as_py()))
                held += len(words[-1]) + 1
                if held >= GROUP or row + 1 == b.num_rows:
                    runs = _of_group(words, least_words, least_periods)
                    flat = np.array([r for one in runs for r in one], np.int64).reshape(-1, 3)
                    offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                    spans = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
                    kept = pa.array([_collapsed(w, r).decode("utf-8", "surrogatepass") for w, r in zip(words, runs)], pa.string())
                    cols = [ids.slice(first, len(words)), pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(offsets, spans), kept]
                    yield pa.RecordBatch.from_arrays(cols, names=[key, "n_words", "runs", "collapsed"])
                    words, held, first = [], 0, row + 1

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_words long, runs {RUNS}, collapsed string")


def most_repeated(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first. Null if there is none."""

    def better(best: Column, r: Column) -> Column:
        # Products of two counts of words of one text.
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def with_periods(docs: DataFrame) -> DataFrame:
    """The query's input: of one text in ten, by the checksum of its id, the words from a certain one on repeat with a certain period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")

    def repeated(w: Column) -> Column:
        g, n = F.floor(h / 10), F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), F.transform(F.slice(w, a + 1, n), lambda _, i: F.get(w, a + i % p))), " ")

    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    # Bound by an array of one, so that a text is cut into words once.
    text = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise("")), 1)
    return docs.select("doc_id", F.when(chosen, text).otherwise(F.col("text")).alias("text"))


def runs_report(docs: DataFrame) -> DataFrame:
    """The digest columns of the query."""
    rows = find_runs(with_periods(docs)).withColumn("best", most_repeated(F.col("runs")))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
