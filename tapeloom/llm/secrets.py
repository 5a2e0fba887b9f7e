"""Operator 1, secret scans: a trigram inverted index picks candidates, rules verify them. Native.

Each rule's regular expression is parsed into a Boolean query over trigrams (any of some clauses,
each needing all its trigrams). The index has a posting (trigram, document) for each trigram that
some query names. Intersecting postings gives (document, rule) candidates; only those are verified
by the regular expression. A rule with no mandatory trigram is run over every text.

Defined results: null text is empty; null ids are kept; rows that share an id are each scanned;
an empty table gives an empty result; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm import spans as S
from tapeloom.llm.common import written


@dataclass(frozen=True)
class Rule:
    """``pattern`` must mean the same to Java and Python. ``least``: characters that ``group`` must have."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


#: The three base rules, then rules for well-known token formats.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    # From the start of a run of its characters on, and never going back into one: else a run is tried at each of its places.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
)

MOST_CLAUSES = 64
GAP = None


def _expand(items) -> list[tuple]:
    """Alternatives of a parsed expression, each a sequence of literal characters and gaps."""
    out: list[tuple] = [()]
    for op, arg in items:
        if op is C.LITERAL:
            parts = [(chr(arg).lower(),)]
        elif op is C.IN and all(o is C.LITERAL for o, _ in arg):
            parts = sorted({(chr(a).lower(),) for _, a in arg})
        elif op is C.BRANCH:
            parts = [p for branch in arg[1] for p in _expand(branch)]
        elif op is C.SUBPATTERN:
            parts = _expand(arg[3])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            least, most, inner = arg
            body = _expand(inner)
            if (least, most) == (0, 1):
                parts = [(), *body]
            else:
                parts = [p + (GAP,) for p in body] if least else [(GAP,)]
        elif op in (C.AT, C.ASSERT, C.ASSERT_NOT):
            parts = [()]
        else:
            parts = [(GAP,)]
        if len(out) * len(parts) > MOST_CLAUSES:
            parts = [(GAP,)]
        out = [a + b for a in out for b in parts]
    return out


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses any of which must hold, each a set of lower-case trigrams that all occur; [] if some match needs none."""
    clauses = set()
    for seq in _expand(parser.parse(pattern)):
        runs = "".join("\0" if c is GAP else c for c in seq).split("\0")
        clauses.add(frozenset(r[i : i + 3] for r in runs for i in range(len(r) - 2)))
    # A clause that asks for more than another one adds nothing.
    return [] if frozenset() in clauses else sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


def postings(docs: DataFrame, trigrams: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index over the named trigrams: one row (trigram, key) for each that a text has, in either case."""
    low = docs.select(F.col(key).alias("key"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select(F.explode(present).alias("trigram"), "key")


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """Intersects postings: (key, kinds) with the rules whose query holds. The clause table has a few rows for each rule."""
    rows = []
    for r in rules:
        for n, clause in enumerate(trigram_query(r.pattern)):
            rows += [(t, r.kind, n, 1 << i, (1 << len(clause)) - 1) for i, t in enumerate(sorted(clause))]
    clauses = index.sparkSession.createDataFrame(rows, "trigram string, kind string, clause int, bit long, full long")
    met = index.join(F.broadcast(clauses), "trigram").groupBy("key", "kind", "clause", "full").agg(F.bit_or("bit").alias("bits"))
    return met.where("bits = full").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def verify(text: Column, rules, queries: dict) -> Column:
    """Spans of the rules that a text (with its candidates, ``kinds``) may match."""
    found = S.find(text, [(r.kind, r.pattern, F.array_contains("kinds", r.kind) if queries[r.kind] else None) for r in rules])

    def holds(s: Column) -> Column:
        enough = F.lit(True)
        for r in rules:
            enough = F.when(s["kind"] == r.kind, F.char_length(F.regexp_extract(s["hit"], r.pattern, r.group)) >= r.least).otherwise(enough)
        return enough

    return F.filter(found, holds)


def scan_secrets(docs: DataFrame, rules=RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: ``key`` and ``found``, an array of spans."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    trigrams = sorted({t for q in queries.values() for clause in q for t in clause})
    body = docs.select(F.col(key).alias("doc_key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    if trigrams:
        # Written, candidates have a known size: Spark broadcasts them if they are under its threshold, else both sides are dealt by id.
        hits = written(candidates(postings(docs, trigrams, key, text), rules), "candidates")
        body = body.join(hits, body["doc_key"].eqNullSafe(hits["key"]), "left")
    else:
        body = body.withColumn("kinds", F.array().cast("array<string>"))
    return body.select(F.col("doc_key").alias(key), verify(F.col("body"), rules, queries).alias("found"))


def secrets_report(docs: DataFrame) -> DataFrame:
    """The digest columns of the query."""
    base = F.filter("found", lambda s: s["kind"].isin(*[r.kind for r in RULES if r.base]))
    rows = scan_secrets(docs)
    return rows.select(
        "doc_id",
        *[S.count_of(F.col("found"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(S.joined(base).cast("binary"), 256).alias("base_sha256"),
        S.joined(F.col("found")).alias("spans"),
    )
