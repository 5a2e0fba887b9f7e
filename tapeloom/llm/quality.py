"""Operator 2, quality rules: a decision list learned by sequential covering, run as Spark conditionals.

Statistics of each text are taken in one Arrow pass. On a bounded sample of labelled rows the
learner grows conjunctions of thresholds by information gain, prunes each on rows held back, and
adds it to the list while it is precise enough; what no rule covers is kept. The list becomes one
``CASE WHEN`` over the statistics.

Defined results: null text has no words, so its statistics are zero and it fails the base rule;
labels with a null id or a null label are left out, an id labelled more than once counts by its
lowest label, and of the documents that share a labelled id one is learned from, always the same; no usable labels give the empty list, which keeps all that passes the base rule; ids, null or
repeated, are carried as they are; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import ship, words_of

ship(__name__)

#: Labelled rows to learn from at most: those whose ids hash lowest.
MOST_LABELLED = 20_000

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_chars long, n_lines long, n_upper long, n_digits long, n_marks long, n_distinct long, longest long"
)
NAMES = tuple(f.split()[0] for f in STATS.split(", "))
SYMBOLS = "#*$%&|<>"
MARKS = "!?.,;:"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))


def n_repeat_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    total, reach = 0, 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            total += i + 3 - max(i, reach)
            reach = i + 3
    return total


def stats_of(text: str | None) -> tuple[int, ...]:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = text.split("\n")
    dup, seen = 0, set()
    for line in lines:
        if line in seen:
            dup += bool(line.strip(" \t\n\x0b\x0c\r"))
        else:
            seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")),
        sum(map(text.count, SYMBOLS)),
        dup,
        n_repeat_words(words),
        len(text),
        len(lines),
        len(raw) - len(raw.translate(None, _UPPER)),
        len(raw) - len(raw.translate(None, _DIGITS)),
        sum(map(text.count, MARKS)),
        len(set(words)),
        max(map(len, words), default=0),
    )


def with_stats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the statistics of ``text``."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = [stats_of(t) for t in b.column(1).to_pylist()]
            cols = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(NAMES))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[key, *NAMES])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {STATS}")


#: Ratios to learn on, as SQL over the statistics; each in Python and in Spark by the same division.
FEATURES = {
    "n_words": ("n_words", None),
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "words_per_line": ("n_words", "n_lines"),
    "distinct_share": ("n_distinct", "n_words"),
    "longest": ("longest", None),
}


def feature(name: str) -> Column:
    top, below = FEATURES[name]
    top = F.col(top).cast("double")
    return top if below is None else top / F.greatest(F.col(below), F.lit(1)).cast("double")


def matrix(rows) -> np.ndarray:
    """The features of rows of statistics, one column each, in order."""
    of = {n: np.array([r[n] for r in rows], float) for n in NAMES}
    return np.stack([of[t] if b is None else of[t] / np.maximum(of[b], 1) for t, b in FEATURES.values()], 1)


@dataclass(frozen=True)
class Test:
    name: str
    above: bool
    limit: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, list(FEATURES).index(self.name)]
        return v >= self.limit if self.above else v < self.limit

    def column(self) -> Column:
        return feature(self.name) >= self.limit if self.above else feature(self.name) < self.limit

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.limit:.4g}"


def _gain(p: np.ndarray, n: np.ndarray, p0: float, n0: float) -> np.ndarray:
    """FOIL gain of narrowing p0 bad and n0 good rows to p and n."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -np.inf)


def _grow(x: np.ndarray, bad: np.ndarray, longest: int, cuts: int) -> list[Test]:
    tests: list[Test] = []
    inside = np.ones(len(x), bool)
    while len(tests) < longest and (~bad[inside]).any() and bad[inside].any():
        best = (1e-9, None)
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        for k, name in enumerate(FEATURES):
            v, y = x[inside, k], bad[inside]
            order = np.argsort(v, kind="stable")
            v, y = v[order], y[order]
            at = np.unique(np.linspace(0, len(v) - 1, cuts).astype(int))
            at = np.unique(np.searchsorted(v, v[at]))  # the first row of each value
            at = at[at > 0]
            if not len(at):
                continue
            limits = (v[at] + v[at - 1]) / 2
            below_p = np.concatenate([[0], np.cumsum(y)])[at].astype(float)
            below_n = at - below_p
            for above, p, n in ((True, p0 - below_p, n0 - below_n), (False, below_p, below_n)):
                g = _gain(p, n, p0, n0)
                i = int(np.argmax(g))
                if g[i] > best[0]:
                    best = (float(g[i]), Test(name, above, float(limits[i])))
        if best[1] is None:
            break
        tests.append(best[1])
        inside &= best[1].holds(x)
    return tests


def _covers(tests: list[Test], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for t in tests:
        out &= t.holds(x)
    return out


def learn(x: np.ndarray, bad: np.ndarray, precision: float = 0.9, least: int = 5, most_rules: int = 24, longest: int = 4, cuts: int = 64, most_failures: int = 12) -> list[list[Test]]:
    """Conjunctions that mark rows as bad, in the order found. A third of the rows is held back for pruning.

    A conjunction that is not precise enough is tried in full length, unpruned. If that is not either, the bad rows
    that it covers are not sought any more, and the next one grows from the others.
    """
    held = np.arange(len(x)) % 3 == 2
    rules: list[list[Test]] = []
    left = np.ones(len(x), bool)
    sought = np.ones(len(x), bool)
    failures = 0

    def covered(tests: list[Test]) -> np.ndarray | None:
        """The rows left that the rule covers, if it is good enough."""
        c = left & _covers(tests, x)
        held_back = c & held
        good = c.sum() >= least and bad[c].mean() >= precision and not (held_back.any() and bad[held_back].mean() < precision)
        return c if good else None

    while len(rules) < most_rules and failures < most_failures:
        g, h = left & sought & ~held, left & held
        if not bad[g].any():
            break
        tests = _grow(x[g], bad[g], longest, cuts)
        if not tests:
            break

        def worth(k: int) -> float:
            c = _covers(tests[:k], x[h])
            p, n = int(bad[h][c].sum()), int((~bad[h][c]).sum())
            return (p - n) / (p + n) if p + n else -1.0

        pruned = tests[: max(range(1, len(tests) + 1), key=lambda k: (worth(k), -k))]
        for rule in (pruned, tests):
            if (c := covered(rule)) is not None:
                rules.append(rule)
                left &= ~c
                break
        else:
            failures += 1
            sought &= ~(_covers(tests, x) & bad)
    return rules


def verdict(rules: list[list[Test]]) -> Column:
    """The list as an ordered conditional: false where a rule fires, else true."""
    out = None
    for tests in rules:
        cond = tests[0].column()
        for t in tests[1:]:
            cond = cond & t.column()
        out = F.when(cond, False) if out is None else out.when(cond, False)
    return F.lit(True) if out is None else out.otherwise(True)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, key: str = "doc_id", text: str = "text") -> list[list[Test]]:
    """Learns on at most ``most`` labelled ids that documents have, those whose hashes are lowest; of documents that share an id on the text whose hash is lowest."""
    known = labels.where(f"`{key}` is not null and quality is not null").groupBy(F.col(key).alias("__id")).agg(F.min("quality").alias("__quality"))
    body = docs.select(F.col(key).alias("__id"), F.col(text).alias("__text"))
    # Labels without a document teach nothing, so they do not count; only ids are read for that.
    known = known.join(body.select("__id"), "__id", "left_semi").orderBy(F.xxhash64("__id"), "__id").limit(most)
    # At most ``most`` ids of 16 bytes each go to every executor, and as many texts, one for each id, to where they are judged.
    mine = body.join(F.broadcast(known.select("__id")), "__id", "left_semi")
    one = mine.groupBy("__id").agg(F.min_by("__text", F.struct(F.xxhash64("__text"), F.length("__text"), "__text")).alias("__text"))
    rows = with_stats(one, "__id", "__text").join(F.broadcast(known), "__id").collect()
    if not rows:
        return []
    rows.sort(key=lambda r: (hash_of(r["__id"]), r["__id"]))
    return learn(matrix(rows), np.array([r["__quality"] == 0 for r in rows]))


def hash_of(value) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(str(value))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the statistics, base_failed and kept."""
    rules = train(docs, labels, key=key, text=text)
    rows = with_stats(docs, key, text).withColumn("base_failed", base_failed())
    return rows.withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    rules = train(docs, labels, key=key, text=text)

    @F.pandas_udf(STATS)
    def stats(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([stats_of(t) for t in texts], columns=list(NAMES))

    mine = "__stats" + "_" * max(len(c) for c in docs.columns)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), stats(F.col(text)).alias(mine))
    flat = packed.select("__row", f"{mine}.*")
    return flat.where(~base_failed() & verdict(rules)).select("__row.*")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
