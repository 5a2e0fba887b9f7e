"""Operator 4, personal data: patterns propose, checksums confirm, context words adjust the score. Native.

Base kinds (e-mail, IP, card, phone) are always reported. The further kinds, IBAN and national
number, are reported where their score reaches ``THRESHOLD``: an IBAN that passes mod 97 unless a word
before it says that it is made up and none that it is an account; a national number only near a context
word and not a made-up one. Work is linear in the text and its spans.

Defined results: null text is empty; ids, null or repeated, are carried as they are; an empty
table gives an empty result; in ``redact`` all other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions import arrays
from tapeloom.llm import spans as S

#: Fixed values. The patterns match what the plain forms match, but no text makes them retry or recurse:
#: a local part starts at a run's start or where the last match ended, repeats are possessive.
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "national": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
KINDS = tuple(PATTERNS)
BASE = ("email", "ip", "card", "phone")
#: A text without the needle can't match; for the rest there is none.
NEEDLE = {"email": "@", "ip": ".", "phone": "+", "national": "-"}
#: Fixed values, in hundredths: the score before context; words that add ``BONUS`` within ``NEAR`` characters before
#: the span; words that say it is made up, which take ``MALUS`` off.
PRIOR = {"email": 90, "ip": 60, "card": 80, "phone": 60, "iban": 80, "national": 30}
CONTEXT = {
    "email": "mail|email|emails|mails|contact|write",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|pay",
    "phone": "phone|phones|call|tel|telephone|mobile|fax",
    "iban": "iban|bank|account",
    "national": "ssn|social|security|national|tax",
}
MADE_UP = "sample|example|dummy|specimen|placeholder"
BONUS, MALUS, NEAR, THRESHOLD = 30, 40, 40, 50


def word(words: str) -> str:
    """A pattern for one of the words as a whole, in lower-case text; without lookarounds, so that SQL can have it too."""
    return rf"(?:^|[^a-z0-9_])(?:{words})(?:$|[^a-z0-9_])"


def confirmed(kind: Column, hit: Column) -> Column:
    """The validator of each kind, over the matched text."""
    digits = S.only_digits(hit)
    parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return (
        F.when(kind == "card", (F.length(digits) <= 19) & S.luhn(digits))
        .when(kind == "ip", F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255"))))
        .when(kind == "phone", F.length(digits).between(10, 15))
        .when(kind == "iban", S.mod97(F.replace(hit, F.lit(" "), F.lit(""))))
        .otherwise(True)
    )


def score(before: Column, kind: Column) -> Column:
    """Prior of the kind, more for a context word of the kind before the span, less for one that says it is made up; 0 to 100.

    ``before`` is what stands up to ``NEAR`` characters before the span, in lower case.
    """
    bonus = F.lit(False)
    for k in KINDS:
        bonus = F.when(kind == k, before.rlike(word(CONTEXT[k]))).otherwise(bonus)
    prior = F.element_at(F.create_map(*[F.lit(x) for k in KINDS for x in (k, PRIOR[k])]), kind)
    return F.greatest(F.lit(0), F.least(F.lit(100), prior + F.when(bonus, BONUS).otherwise(0) - F.when(before.rlike(word(MADE_UP)), MALUS).otherwise(0)))


SCORED = "array<struct<rank:int,kind:string,start:int,end:int,hit:string,score:int>>"


def spans_of(text: Column) -> Column:
    """All personal data of a text, as an array of spans with their scores."""
    found = S.find(text, [(kind, p, F.contains(text, F.lit(NEEDLE[kind])) if kind in NEEDLE else None) for kind, p in PATTERNS.items()])

    def with_score(s: Column, cut: Column) -> Column:
        before = F.lower(S.part(cut, F.greatest(s["start"] - NEAR, F.lit(0)), s["start"]))
        return F.struct(*[s[f].alias(f) for f in ("rank", "kind", "start", "end", "hit")], arrays.bind(before, lambda b: score(b, s["kind"])).alias("score"))

    def judged(v: Column) -> Column:
        scored = arrays.bind(S.chunks(text), lambda cut: F.transform(v, lambda s: with_score(s, cut)))
        kept = F.filter(scored, lambda s: s["kind"].isin(*BASE) | (s["score"] >= THRESHOLD))
        return F.when(F.size(v) > 0, kept).otherwise(F.array().cast(SCORED))

    return arrays.bind(F.filter(found, lambda s: confirmed(s["kind"], s["hit"])), judged)


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: ``key``, ``body`` and ``found``, an array of spans. No shuffle."""
    body = docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return body.withColumn("found", spans_of(F.col("body")))


def with_scores(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each span: key, kind, start, end, hit and score, 0 to 1."""
    one = found.select(key, F.explode("found").alias("s"))
    return one.select(key, "s.kind", "s.start", "s.end", "s.hit", (F.col("s.score") / F.lit(100.0)).alias("score"))


def merged(spans: Column) -> Column:
    """Overlapping spans as one, named after the first: array<struct<start,end,kind>> in order."""

    def joined(v: Column, reach: Column) -> Column:
        # A span that begins where all before it have ended begins a new one; it ends where those before the next have ended.
        heads = F.filter(F.sequence(F.lit(0), F.size(v) - 1), lambda i: (i == 0) | (F.get(v, i)["start"] >= F.get(reach, i - 1)))

        def one(h: Column, heads: Column, i: Column) -> Column:
            last = F.coalesce(F.get(heads, i + 1), F.size(v)) - 1
            return F.struct(F.get(v, h)["start"].alias("start"), F.get(reach, last).alias("end"), F.get(v, h)["kind"].alias("kind"))

        return arrays.bind(heads, lambda hs: F.transform(hs, lambda h, i: one(h, hs, i)))

    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    full = lambda v: arrays.bind(arrays.running(F.transform(v, lambda s: s["end"]), F.greatest), lambda reach: joined(v, reach))
    return arrays.bind(S.ordered(spans), lambda v: F.when(F.size(v) > 0, full(v)).otherwise(none))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets."""

    def pieces(v: Column, cut: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            begin = F.coalesce(F.get(v, i - 1)["end"], F.lit(0))
            return F.concat(S.part(cut, begin, s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))

        rest = S.part(cut, F.element_at(v, -1)["end"], F.char_length(text))
        return F.concat(F.array_join(F.transform(v, one), ""), rest)

    full = arrays.bind(merged(spans), lambda v: arrays.bind(S.chunks(text), lambda cut: pieces(v, cut)))
    return F.when(F.size(spans) > 0, full).otherwise(text)


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in ``text`` (null stays null) and ``n_chars`` counted anew; all columns kept."""
    mine = "__found" + "_" * max(len(c) for c in docs.columns)
    out = docs.withColumn(mine, spans_of(F.coalesce(F.col(text), F.lit(""))))
    out = out.withColumn(text, F.when(F.col(text).isNotNull(), redacted(F.col(text), F.col(mine))))
    if n_chars in docs.columns:
        out = out.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def pii_report(docs: DataFrame) -> DataFrame:
    """The digest columns of the query."""
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    return find_pii(docs).select(
        "doc_id",
        *[S.count_of(F.col("found"), k).alias(f"n_{k}") for k in BASE],
        F.sha2(S.joined(base).cast("binary"), 256).alias("base_sha256"),
        S.joined(F.col("found")).alias("spans"),
        S.scores(F.col("found")).alias("scores"),
    )
