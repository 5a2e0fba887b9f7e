"""Operator 8, benchmark decontamination: a BM25 inverted index of test items, searched by block-max WAND.

Test items are cut into entries of at most ``HALF`` words, each of which begins with the last four words
of the one before or earlier, so that every word and every five-word shingle of an item is in an entry.
They are indexed: for each word its entries with BM25 impacts, divided by the entry's score against itself so that one threshold fits all entries.
Every text is read as overlapping passages of two times ``HALF`` words, so each place that could hold
an entry lies whole in some passage. A passage is a query, and all entries that reach ``THRESHOLD`` are
retrieved: the lists of its words are ordered by the entry that each is at, and the first list with which
their maxima reach the threshold gives the pivot, before which no entry can; the maxima of the blocks
that the pivot lies in say whether it is worth scoring or whether all lists go past these blocks. Only
blocks with an entry that can reach the threshold are entered. They are found by the entries' rarest words, so that
long lists are not walked: of each entry the words that are in the fewest entries are listed once more,
as many as make up ``RARE`` of its score against itself. All other words together add 1 - ``RARE`` at
most, so a passage that reaches the threshold has rare words for the difference.
Retrieved entries are verified: of the entry's five-word shingles, ``OVERLAP`` must be in the passage, and
half of those of the item's question and of its answer each; a side that the entry has no shingles of
counts as found. An item of fewer than five words has one shingle, all of its words.

The index is broadcast. Items and their characters are counted first and searched in shards of about
``MOST_ITEMS`` items at most. Of several shards one is broadcast at a time: what it finds is written before it
is destroyed and the next one made. The number of entries, their mean length and in how many each word
is are then counted over all items first, and each shard gets them for its own words: scores are
those of one index.

Defined results: null text has no words; items without words are not searched, nor are null ones; ids
of texts and items, null or repeated, are carried as they are; rows of items that are alike in id and
text are one item for the index and its scores, found as often as there are rows; empty
tables give no rows; columns other than ids and texts are not looked at by ``contaminated`` and are
kept by ``keep_clean``.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable
from functools import reduce
from itertools import chain
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tapeloom.llm.common import removed, ship, written

ship(__name__)

HALF = 64
SHINGLE = 5
THRESHOLD = 0.6
OVERLAP = 0.8
PART_OVERLAP = 0.5
#: Entries in a block.
BLOCK = 8
#: Share of an entry's score against itself that its listed rare words make up, at least.
RARE = 0.7
#: Postings of rare words that are looked at together.
POSTINGS = 1 << 18
#: Characters of texts, or one text, that are searched together: what a task holds besides its batch.
TEXTS = 1 << 20
#: Items in a shard, and characters of items that count as one more.
MOST_ITEMS, ITEM_CHARS = 20_000, 512
K1, B = 1.2, 0.75

#: Lower case; punctuation is white space.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def shingles(ids: list[int], size: int = SHINGLE) -> list[tuple[int, ...]]:
    return list(zip(*[ids[i:] for i in range(size)]))


def _new(values: np.ndarray) -> np.ndarray:
    """Where sorted values differ from the one before."""
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def entries_of(words: list) -> list[tuple[int, list]]:
    """Where in an item's words each entry begins, and its words; the last entry is the last ``HALF`` words."""
    last = max(0, len(words) - HALF)
    return [(at, words[at : at + HALF]) for at in (*range(0, last, HALF - SHINGLE + 1), last)] if words else []


class Index:
    """Entries of test items, by word. Items are (id, text) or (id, text, number of such rows).

    ``totals`` has, by word, in how many entries it is, and under None the number of entries and of their words; by default those of ``items``.
    """

    def __init__(self, items: list[tuple], totals: dict[bytes | None, tuple[int, int]] | None = None):
        self.vocabulary: dict[bytes, int] = {}
        self.item, self.times, self.parts, self.shingle = [], [], [], []
        entries: list[list[int]] = []
        for item, text, *times in items:
            raw = (text or "").encode("utf-8", "surrogatepass")
            ask = raw.rfind(b"?") + 1
            n_ask = len(raw[:ask].translate(_PLAIN).split()) if ask else 0
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in plain_words(text)]
            # The question ends at the last question mark, or else half way.
            cut = n_ask if 0 < n_ask < len(words) else len(words) // 2
            first = max(1, min(len(words) - SHINGLE, cut - SHINGLE // 2))
            for at, ids in entries_of(words):
                entries.append(ids)
                self.item.append(item)
                self.times.append(times[0] if times else 1)
                self.shingle.append(min(SHINGLE, len(words)))
                all_of = shingles(ids, self.shingle[-1])
                split = max(0, first - at)
                self.parts.append((set(all_of[:split]), set(all_of[split:])))
        self.n = len(entries)
        self._impacts(entries, totals)

    def _impacts(self, entries: list[list[int]], totals: dict[bytes | None, tuple[int, int]] | None) -> None:
        n_words = len(self.vocabulary)
        counts = [np.unique(np.array(e, np.int64), return_counts=True) for e in entries]
        term = np.concatenate([c[0] for c in counts] or [np.zeros(0, np.int64)])
        tf = np.concatenate([c[1] for c in counts] or [np.zeros(0, np.int64)])
        entry = np.repeat(np.arange(self.n), [len(c[0]) for c in counts])
        length = np.array([len(e) for e in entries], float)
        df, n, n_length = np.bincount(term, minlength=n_words), self.n, length.sum()
        if totals:
            df = np.array([totals.get(w, (0, 0))[0] for w in self.vocabulary], np.int64)
            n, n_length = totals[None]
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length / max(n_length / max(n, 1), 1))
        impact = idf[term] * tf * (K1 + 1) / (tf + norm[entry])
        impact /= np.bincount(entry, impact, minlength=self.n)[entry]
        order = np.lexsort((entry, term))
        term, entry, impact = term[order], entry[order], impact[order]
        self.entry, self.impact = array("q", entry.tolist()), array("d", impact.tolist())
        self.begin = np.searchsorted(term, np.arange(n_words + 1)).tolist()
        # Block maxima: one row for each word and block of entries.
        key = term * (self.n // BLOCK + 1) + entry // BLOCK
        first = np.flatnonzero(_new(key))
        self.block_key = key[first]
        self.block = array("q", (entry // BLOCK)[first].tolist())
        self.block_max = array("d", (np.maximum.reduceat(impact, first) if len(first) else impact).tolist())
        self.block_begin = array("q", np.searchsorted(term[first], np.arange(n_words + 1)).tolist())
        # Rare words: from the rarest on, until those before make up the share.
        by = np.lexsort((term, df[term], entry))
        sums = np.cumsum(impact[by])
        starts = np.flatnonzero(_new(entry[by])) if len(by) else by
        before = sums - impact[by]
        before -= np.repeat(before[starts], np.diff(np.append(starts, len(by))))
        rare = by[before < RARE]
        rare = rare[np.lexsort((entry[rare], term[rare]))]
        self.rare_entry, self.rare_impact = entry[rare], impact[rare]
        self.rare_begin = np.searchsorted(term[rare], np.arange(n_words + 2))
        self.rare_sum = np.bincount(entry[rare], impact[rare], minlength=self.n)
        # List maxima; the last is for words that are in no entry.
        self.list_max = np.zeros(n_words + 1, np.float32)
        np.maximum.at(self.list_max, term, impact.astype(np.float32) * np.float32(1.000001))

    def near(self, rows: np.ndarray, joined: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
        """(row, block), in order: blocks with an entry of which the passage that begins with the row has the rare words that the threshold takes.

        Passages are rows of words; where ``joined``, the next row belongs to the passage too.
        """
        n_blocks = -(-self.n // BLOCK)
        need = self.rare_sum - (1 - threshold) - 1e-8
        if not self.n or need.min() <= 0:
            return np.repeat(np.arange(len(rows)), n_blocks), np.tile(np.arange(n_blocks), len(rows))
        words = np.sort(rows, axis=1)
        first = words < len(self.vocabulary)
        first[:, 1:] &= words[:, 1:] != words[:, :-1]
        row, term = np.nonzero(first)[0], words[first]
        begin = self.rare_begin[term]
        n = self.rare_begin[term + 1] - begin
        row, begin, n = row[n > 0], begin[n > 0], n[n > 0]
        ends = np.cumsum(np.bincount(row, n, minlength=len(rows)))
        found = [np.zeros(0, np.int64)]
        k = to = 0
        while to < len(rows):
            # Rows with about POSTINGS, but two at least; the last is also the next ones' first.
            to = min(len(rows), max(k + 2, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + POSTINGS))))
            mine = slice(*np.searchsorted(row, (k, to)))
            m = n[mine]
            at = np.repeat(begin[mine] - np.cumsum(m) + m, m) + np.arange(m.sum())
            key = np.repeat(row[mine], m) * self.n + self.rare_entry[at]
            order = np.argsort(key)
            key = key[order]
            starts = np.flatnonzero(_new(key))
            sums, key = (np.add.reduceat(self.rare_impact[at[order]], starts) if len(starts) else np.zeros(0)), key[starts]

            def of(some: np.ndarray) -> np.ndarray:
                place = np.minimum(np.searchsorted(key, some), len(key) - 1)
                return np.where(key[place] == some, sums[place], 0)

            # One of a passage's rows has half of what it takes. Words in both count twice, which lets no entry go.
            half = np.flatnonzero(sums >= need[key % self.n] / 2)
            if len(half):
                own, key_of = sums[half], key[half]
                with_next = own + np.where(joined[key_of // self.n], of(key_of + self.n), 0)
                with_last = np.where((key_of >= self.n) & joined[key_of // self.n - 1], own + of(key_of - self.n), 0)
                for total, some in ((with_next, key_of), (with_last, key_of - self.n)):
                    some = some[total >= need[some % self.n]]
                    found.append(some // self.n * n_blocks + some % self.n // BLOCK)
            k = to - 1
        places = np.unique(np.concatenate(found))
        return places // n_blocks, places % n_blocks

    def search(self, ids: np.ndarray, threshold: float = THRESHOLD, blocks: np.ndarray | None = None) -> list[tuple[int, float]]:
        """Entries that reach the threshold, with their scores, in order: block-max WAND. ``blocks``, in order, are those that may hold one."""
        terms = np.sort(ids[ids < len(self.vocabulary)])
        terms = terms[_new(terms)]
        least = threshold - 1e-9
        bound = least - 1e-9  # sums differ by the order of their terms
        if self.list_max[terms].sum(dtype=float) < bound:
            return []
        # The lists only ever move to blocks in which the maxima of all lists reach the threshold, in order.
        places = self.near(terms[None], np.zeros(1, bool), threshold)[1] if blocks is None else blocks
        wide = self.n // BLOCK + 1
        keys = terms[:, None] * wide + places
        at = np.minimum(np.searchsorted(self.block_key, keys), len(self.block_key) - 1)
        inside = self.block_key[at] == keys
        enough = np.where(inside, np.frombuffer(self.block_max)[at], 0).sum(0) >= bound
        alive = places[enough].tolist()
        if not alive:
            return []
        # Lists without a posting in these blocks have nothing to add.
        terms = terms[inside[:, enough].any(1)]
        maxima = self.list_max[terms].tolist()
        entry, impact, block, block_max = self.entry, self.impact, self.block, self.block_max
        # A list: the entry that it is at, the places of that posting and of the list's end, of the block and of the last one's end, the maximum.
        lists = [[-1, self.begin[t], self.begin[t + 1], self.block_begin[t], self.block_begin[t + 1], m] for t, m in zip(terms.tolist(), maxima)]
        out = []

        def advance(some: list[list], target: int) -> None:
            """Moves lists to their first entry from ``target`` on; those that end go."""
            ended = False
            for x in some:
                if x[0] < target:
                    x[1] = bisect_left(entry, target, x[1], x[2])
                    if x[1] < x[2]:
                        x[0] = entry[x[1]]
                    else:
                        x[0], ended = -1, True
            if ended:
                lists[:] = [x for x in lists if x[0] >= 0]

        advance(lists, alive[0] * BLOCK)
        first_of, now = itemgetter(0), 0
        while lists:
            lists.sort(key=first_of)
            reach, pivot = 0.0, -1
            for p, x in enumerate(lists):
                reach += x[5]
                if reach >= bound:
                    pivot = x[0]
                    break
            if pivot < 0:
                break
            p += 1
            while p < len(lists) and lists[p][0] == pivot:
                p += 1
            here, reach = pivot // BLOCK, 0.0
            now = bisect_left(alive, here, now)
            if now == len(alive):
                break
            if alive[now] > here:
                advance(lists, alive[now] * BLOCK)
                continue
            # The lists up to the pivot: what their blocks allow.
            for x in lists[:p]:
                k = x[3] = bisect_left(block, here, x[3], x[4])
                if k < x[4] and block[k] == here:
                    reach += block_max[k]
            if reach < bound:
                after = (here + 1) * BLOCK
                advance(lists[:p], min(after, lists[p][0]) if p < len(lists) else after)
            elif lists[0][0] == pivot:
                score = sum(impact[x[1]] for x in lists[:p])
                if score >= least:
                    out.append((pivot, score))
                advance(lists[:p], pivot + 1)
            else:
                advance(lists[:p], pivot)
        return out

    def verify(self, ids: np.ndarray, entry: int) -> tuple[float, float] | None:
        """Overlaps of question and answer, if enough."""
        have = set(shingles(ids.tolist(), self.shingle[entry]))
        ask, answer = self.parts[entry]
        in_ask, in_answer = len(ask & have), len(answer & have)
        if in_ask + in_answer < OVERLAP * (len(ask) + len(answer)):
            return None
        shares = [n / len(s) if s else 1.0 for n, s in ((in_ask, ask), (in_answer, answer))]
        return (shares[0], shares[1]) if min(shares) >= PART_OVERLAP else None

    def leaks(self, texts: Iterable[str | None]) -> list[tuple[int, int, float, float, float]]:
        """(position of the text, entry, score, overlap of question, of answer), the best passage of each entry."""
        out, some, first, size = [], [], 0, 0
        for t in chain(texts, [None]):
            some.append(t)
            size += len(t or "")
            if size >= TEXTS:
                out += [(first + i, *found) for i, *found in self._leaks(some)]
                first, size, some = first + len(some), 0, []
        return out + [(first + i, *found) for i, *found in self._leaks(some)]

    def _leaks(self, texts: list[str | None]) -> list[tuple[int, int, float, float, float]]:
        none = len(self.vocabulary)
        get = self.vocabulary.get
        parts, owner = [], []
        for i, t in enumerate(texts):
            ids = [get(w, none) for w in plain_words(t)]
            if ids:
                row = np.full(-(-len(ids) // HALF) * HALF, none, np.int64)
                row[: len(ids)] = ids
                parts.append(row.reshape(-1, HALF))
                owner.append(np.full(len(parts[-1]), i))
        if not parts or not self.n:
            return []
        ids, owner = np.concatenate(parts), np.concatenate(owner)
        half = np.concatenate([self.list_max[ids[k : k + 8192]].sum(1) for k in range(0, len(ids), 8192)])
        more = np.append(owner[1:] == owner[:-1], False)
        bound = half + np.where(more, np.append(half[1:], 0), 0)
        # A passage begins at each half; the last half of a longer text is in the passage before it.
        begins = more | np.append(True, owner[1:] != owner[:-1])
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        asked = begins & (bound >= THRESHOLD - 1e-4)
        of = np.flatnonzero(asked | np.append(False, (asked & more)[:-1]))
        row, block = self.near(ids[of], more[of])
        block, row = block[asked[of[row]]], of[row][asked[of[row]]]
        starts = np.flatnonzero(_new(row)).tolist()
        for a, z in zip(starts, [*starts[1:], len(row)]):
            k = int(row[a])
            passage = ids[k : k + 2].ravel() if more[k] else ids[k]
            for entry, score in self.search(passage, blocks=block[a:z]):
                shares = self.verify(passage, entry)
                if shares:
                    at = (int(owner[k]), entry)
                    best[at] = max(best.get(at, (0.0, 0.0, 0.0)), (score, *shares))
        return [(i, e, *v) for (i, e), v in sorted(best.items())]


FOUND = "score double, question_overlap double, answer_overlap double"


def totals_of(items: DataFrame) -> DataFrame:
    """Rows (shard, word, n, words) for each shard of (shard, text) and word in it: in how many entries of all shards the word is; in a shard's row for null, the number of all entries and of their words."""

    def run(batches):
        for b in batches:
            n, length = Counter(), Counter()
            for shard, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for _, words in entries_of(plain_words(text)):
                    n.update((shard, w) for w in {None, *words})
                    length[shard, None] += len(words)
            columns = [[k[0] for k in n], [k[1] for k in n], list(n.values()), [length[k] for k in n]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.int64(), pa.int64()))], names=["shard", "word", "n", "words"])

    counts = items.select("shard", "text").mapInArrow(run, "shard int, word binary, n long, words long").groupBy("shard", "word").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    # A row for each shard and word at most meets under a word.
    every = Window.partitionBy("word")
    return counts.select("shard", "word", F.sum("n").over(every).alias("n"), F.sum("words").over(every).alias("words"))


def shards_of(items: DataFrame, most: int) -> tuple[int, DataFrame]:
    """The number of shards, and the distinct items, with how often they are there, and their shard: about ``most`` to each."""
    items = items.where("text is not null").groupBy("item_id", "text").agg(F.count("*").cast("int").alias("times"))
    n = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    shards = max(1, -(-n["n"] // most), -(-n["chars"] // (most * ITEM_CHARS)))
    of = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int")
    return shards, items.select("item_id", "text", "times", of.alias("shard"))


def index_of(items: DataFrame, shard: int, totals: DataFrame | None = None):
    """The broadcast index of a shard."""
    mine = F.col("shard") == shard
    rows = items.where(mine).select("item_id", "text", "times").collect()
    rows = sorted(((r[0], r[1], r[2]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    counted = {None if r[0] is None else bytes(r[0]): (r[1], r[2]) for r in totals.where(mine).select("word", "n", "words").collect()} if totals is not None else None
    return items.sparkSession.sparkContext.broadcast(Index(rows, counted))


def each_shard(items: DataFrame, most: int, find) -> DataFrame:
    """``find(index)`` of all shards. If there are several, each one's rows are written before its index is destroyed and the next one made."""
    shards, rest = shards_of(items, most)
    if shards == 1:
        return find(index_of(rest, 0))
    totals, parts = written(totals_of(rest), "totals"), []
    for shard in range(shards):
        index = index_of(rest, shard, totals)
        parts.append(written(find(index), "leaks"))
        index.destroy()
    removed(totals)
    return reduce(DataFrame.unionByName, parts)


def _finder(index, item_type: pa.DataType):
    def run(batches):
        x = index.value
        for b in batches:
            found = x.leaks(v.as_py() for v in b.column(1))
            ids = b.column(0).take(pa.array([f[0] for f in found], pa.int64()))
            item = pa.array([x.item[f[1]] for f in found], item_type)
            times = pa.array([x.times[f[1]] for f in found], pa.int32())
            yield pa.RecordBatch.from_arrays([ids, item, *[pa.array([f[i] for f in found], pa.float64()) for i in (2, 3, 4)], times], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "times"])

    return run


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", most: int = MOST_ITEMS) -> DataFrame:
    """Rows (doc_id, item_id, score, question_overlap, answer_overlap), one for each entry of an item that a text holds."""
    item_field = items.schema["item_id"]
    schema = f"doc_id {docs.schema[key].dataType.simpleString()}, item_id {item_field.dataType.simpleString()}, {FOUND}"
    found = each_shard(items, most, lambda index: docs.select(key, text).mapInArrow(_finder(index, to_arrow_type(item_field.dataType)), f"{schema}, times int"))
    return found.withColumn("times", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("times")


def _holds(index):
    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), bool)
        out[[f[0] for f in index.value.leaks(texts)]] = True
        return pd.Series(out)

    return holds


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", most: int = MOST_ITEMS) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns. No shuffle but for several shards: then the hashes of texts that hold one are written, and the rows that have them go."""
    body = F.col(f"`{text}`")
    shards, rest = shards_of(items, most)
    if shards == 1:
        return docs.where(~_holds(index_of(rest, 0))(body))
    mine = "__hash" + "_" * max(len(c) for c in docs.columns)  # longer than any column's name
    leaks = each_shard(items, most, lambda index: docs.where(_holds(index)(body)).select(F.sha2(body.cast("binary"), 256).alias(mine)).distinct())
    return docs.join(written(leaks.distinct(), "leaks"), F.sha2(F.coalesce(body, F.lit("")).cast("binary"), 256) == F.col(mine), "left_anti")
