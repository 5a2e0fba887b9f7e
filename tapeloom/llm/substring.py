"""Operator 10, substring dedup: difference-cover anchors find what may repeat, windows decide.

A difference cover D of period P has, for every shift, two members that far apart modulo P. So two
occurrences of one run of ``WINDOW`` words, wherever they begin, both have an anchor at the same
place of the run within its first P words: anchors are runs of ``WINDOW - P + 1`` words that begin at
positions in D modulo P. Only these, six in 31 positions, are hashed and dealt by hash. Windows
that hold an anchor which another document has too are then hashed whole, by 96 bits, and the
smallest document id of each window decides.

Occurrences that a task can settle from its own documents never travel: of a hash that several
documents of one task share, a single row does, so a passage that very many documents share is
dealt as one row for each task at most. Nor do the places of a hash within one text, which a text that
says one thing over and over has very many of: they are one row with a list.

Defined results: null text has no words; documents of fewer than ``WINDOW`` words lose none; a null id
counts as larger than any other; rows that repeat an id are one document in two parts (neither
makes the other lose words) and are each returned; an empty table gives no rows; columns other than
the id and the text are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import WordHash, ship, words_of, written

ship(__name__)

WINDOW = 50
#: A perfect difference set, each shift modulo the period once.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
#: Stands for a null id: no other is larger.
NO_ID = 2**63 - 1

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse."""
    held = _POWERS.get((base, 0))
    if held is None or len(held[0]) < n:
        size = max(n, 4096) * 2
        inverse = pow(base, -1, 2**64)
        with np.errstate(over="ignore"):
            held = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]), dtype=np.uint64) for b in (base, inverse))
        _POWERS[base, 0] = held
    return held


def run_hashes(words: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` words, from the words' own hashes."""
    n = len(words)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = _powers(_ODD[which], n + 1)
    with np.errstate(over="ignore"):
        if which:
            words = (words ^ (words >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[:n], dtype=np.uint64)])
        h = (sums[length:] - sums[:-length]) * down[: n - length + 1]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def anchors_at(n_words: int) -> np.ndarray:
    at = np.arange(max(n_words - ANCHOR + 1, 0))
    return at[np.isin(at % PERIOD, COVER)]


def _hashed(text: str | None, seen: WordHash) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


class _Task:
    """Occurrences (hash, second hash, document, row, position) of one task, and what can be settled here."""

    def __init__(self, most: int):
        self.most, self.parts, self.n = most, [], 0

    def add(self, *cols: np.ndarray) -> bool:
        self.parts.append(cols)
        self.n += len(cols[0])
        return self.n >= self.most

    def settle(self) -> tuple[np.ndarray, ...]:
        """Columns sorted by hash, then document; with the group's first and last document."""
        cols = [np.concatenate(c) for c in zip(*self.parts)]
        self.parts, self.n = [], 0
        # Stable, so that the places of a hash in one text stay together.
        order = np.lexsort((cols[2], cols[1], cols[0]))
        cols = [c[order] for c in cols]
        new = np.ones(len(order), bool)
        new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
        group = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(order)) - 1
        return (*cols, new, cols[2][begin][group], cols[2][end][group])


#: Occurrences that a task holds at once.
HELD = 3_000_000
#: What changes from row to row comes first, so that the rest compresses as one run.
FOUND = "h long, g int, pos int, settled boolean, more array<int>, doc long, row long"


def _rows(h, g, doc, row, pos, settled):
    """Sorted as ``settle`` leaves them. Further places of a hash in one text are in ``more`` of the first, unless settled."""
    import pyarrow as pa

    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (g[1:] == g[:-1]) & (doc[1:] == doc[:-1]) & (row[1:] == row[:-1]) & ~settled[1:] & ~settled[:-1]
    kept = ~same
    n = int(kept.sum())
    if n < len(h):
        counts = np.bincount((np.cumsum(kept) - 1)[same], minlength=n)
        more = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(pos[same].astype(np.int32)), mask=pa.array(counts == 0))
    else:
        more = pa.nulls(n, pa.list_(pa.int32()))
    h, g, doc, row, pos, settled = (c[kept] for c in (h, g, doc, row, pos, settled))
    cols = [pa.array(h.view(np.int64)), pa.array(g.astype(np.int32)), pa.array(pos.astype(np.int32)), pa.array(settled), more, pa.array(doc), pa.array(row)]
    return pa.RecordBatch.from_arrays(cols, names=["h", "g", "pos", "settled", "more", "doc", "row"])


def _places():
    """``pos`` and those in ``more``, a row each."""
    return F.explode(F.when(F.col("more").isNull(), F.array("pos")).otherwise(F.concat(F.array("pos"), "more"))).alias("pos")


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, doc, text): ``row`` tells rows apart that share an id and a text; ``doc`` is the id, or NO_ID."""
    return docs.select(F.coalesce(F.col(key), F.lit(NO_ID)).cast("long").alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row"), F.col(text).alias("text"))


def _anchors(batches):
    seen, task = WordHash(), _Task(HELD)

    def flush():
        h, _, doc, row, pos, new, first, last = task.settle()
        settled = first != last
        # Of a settled hash one row goes on to tell others; the rest are spread by where they are.
        at = (doc * 1_000_003 + row + pos * 7919).astype(np.uint64)
        told = new & settled
        yield _rows(np.where(settled, at, h), np.zeros(len(h), np.int32), doc, row, pos, settled)
        if told.any():
            yield _rows(h[told], np.ones(int(told.sum()), np.int32), doc[told], row[told], np.full(int(told.sum()), -1), np.ones(int(told.sum()), bool))

    for b in batches:
        for doc, row, text in zip(*(c.to_pylist() for c in b.columns)):
            words = _hashed(text, seen)
            if len(words) < WINDOW:
                continue
            at = anchors_at(len(words))
            h = run_hashes(words, ANCHOR)[at]
            if task.add(h, np.zeros(len(at), np.int8), np.full(len(at), doc), np.full(len(at), row), at):
                yield from flush()
    if task.parts:
        yield from flush()


def shared_anchors(rows: DataFrame) -> DataFrame:
    """(doc, row, pos) of the anchors that more than one document has."""
    found = rows.mapInArrow(_anchors, FOUND)
    # A hash has two rows for each task at most, or one for each row of one id.
    same = Window.partitionBy("h")
    asked = found.withColumn("told", F.max(F.col("g")).over(same)).withColumn("lo", F.min("doc").over(same)).withColumn("hi", F.max("doc").over(same))
    # Rows settled in their task bear a hash of their place; what shares it by chance is only a candidate too many.
    return asked.where("pos >= 0 and (settled or told = 1 or lo <> hi)").select("doc", "row", _places())


def _windows(batches):
    seen, task = WordHash(), _Task(HELD // 2)

    def flush():
        h, g, doc, row, pos, new, first, _ = task.settle()
        settled = doc > first
        # Settled windows are spread by where they are and say so; the smallest document's go on to be compared.
        at = (doc * 1_000_003 + row + pos * 7919).astype(np.uint64)
        yield _rows(np.where(settled, at, h), np.where(settled, np.zeros_like(g), g), doc, row, pos, settled)

    for b in batches:
        for doc, row, text, places in zip(*(c.to_pylist() for c in b.columns)):
            words = _hashed(text, seen)
            n = len(words) - WINDOW + 1
            mark = np.zeros(n + 1, np.int32)
            places = np.array(places)
            # Windows that hold an anchor at p begin from p - (WINDOW - ANCHOR) to p.
            np.add.at(mark, np.maximum(places - (WINDOW - ANCHOR), 0), 1)
            np.add.at(mark, np.minimum(places + 1, n), -1)
            at = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            if task.add(run_hashes(words, WINDOW)[at], run_hashes(words, WINDOW, 1)[at].astype(np.uint32).view(np.int32), np.full(len(at), doc), np.full(len(at), row), at):
                yield from flush()
    if task.parts:
        yield from flush()


def repeated_windows(texts: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc, row, starts): where windows begin that a smaller document has."""
    places = anchors.groupBy("doc", "row").agg(F.collect_list("pos").alias("places"))
    held = texts.join(places.hint("shuffle_hash"), ["doc", "row"]).select("doc", "row", "text", "places")
    found = held.mapInArrow(_windows, FOUND)
    least = F.min(F.when(~F.col("settled"), F.col("doc"))).over(Window.partitionBy("h", "g"))
    gone = found.withColumn("least", least).where("settled or doc > least").select("doc", "row", _places())
    return gone.groupBy("doc", "row").agg(F.collect_set("pos").alias("starts"))


def without(text: str | None, starts: list[int] | None) -> tuple[int, int, str]:
    """Words, words removed, and the kept words joined by one space."""
    words = words_of(text)
    if not starts:
        return len(words), 0, b" ".join(words).decode("utf-8", "surrogatepass")
    mark = np.zeros(len(words) + 1, np.int32)
    starts = np.array(starts)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + WINDOW, -1)
    gone = np.cumsum(mark[:-1]) > 0
    return len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist()) if not g]).decode("utf-8", "surrogatepass")


def _kept(digest_only: bool):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = [without(t, s) for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            kept = [hashlib.sha256(r[2].encode("utf-8", "surrogatepass")).hexdigest() if digest_only else r[2] for r in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(kept, pa.string())], names=["doc", "n_words", "n_removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", digest_only: bool = False) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept): ``kept`` is the text without repeats, or its SHA-256."""
    spark = docs.sparkSession
    rows = numbered(docs, key, text)
    anchors = written(shared_anchors(rows), "anchors")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The texts are dealt once; both joins below read that exchange.
    texts = rows.repartition(n, "doc", "row")
    gone = repeated_windows(texts, anchors)
    out = texts.join(gone.hint("shuffle_hash"), ["doc", "row"], "left").select("doc", "text", "starts").mapInArrow(_kept(digest_only), "doc long, n_words long, n_removed long, kept string")
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).cast(docs.schema[key].dataType).alias(key), "n_words", "n_removed", "kept")


def substring_report(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, digest_only=True).withColumnRenamed("kept", "kept_sha256")
