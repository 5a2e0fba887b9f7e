"""Spans of regular expressions as DataFrame expressions: no Python on the executors.

A span is ``struct<kind, rank, start, end, hit>``; offsets count code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeloom.functions import arrays

#: Code points in a chunk of a text: see ``chunks``.
CHUNK = 1024
SPAN = "array<struct<rank:int,kind:string,start:int,end:int,hit:string>>"


def find(text: Column, patterns: list[tuple[str, str, Column | None]]) -> Column:
    """All leftmost non-overlapping matches of each (kind, pattern, condition) where the condition holds, as an array of spans, kind after kind.

    Offsets are running sums over the lengths of the pieces that a split at the same pattern leaves,
    so the work is linear in the text and in its matches.
    A pattern must match at least one character and be linear in the text.
    """
    none = F.array().cast("array<string>")
    each = []
    for rank, (kind, pattern, given) in enumerate(patterns):
        may = text.rlike(pattern) if given is None else given & text.rlike(pattern)
        both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps"))
        pieces = F.when(may, both).otherwise(F.struct(none.alias("hits"), none.alias("gaps")))
        each.append(F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), pieces.alias("of")))

    def placed(v: Column) -> Column:
        sizes = F.transform(v["of"]["hits"], lambda h, i: F.char_length(F.get(v["of"]["gaps"], i)) + F.char_length(h))
        ends = arrays.running(sizes, lambda x, y: x + y)

        def span(e: Column, h: Column) -> Column:
            return F.struct(v["rank"].alias("rank"), v["kind"].alias("kind"), (e - F.char_length(h)).alias("start"), e.alias("end"), h.alias("hit"))

        return F.zip_with(ends, v["of"]["hits"], span).cast(SPAN)

    found = F.filter(F.array(*each), lambda v: F.size(v["of"]["hits"]) > 0)
    return F.flatten(F.transform(found, placed))


def chunks(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` code points: a place in it is then found without going through all before it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}+"), F.lit(0))


def part(cut: Column, begin: Column, end: Column) -> Column:
    """The characters from ``begin`` to ``end`` of a text in ``chunks``."""

    def at(place: Column) -> Column:
        return F.floor(place / CHUNK).cast("int")

    first, last = at(begin), at(end)
    head = F.substring(F.get(cut, first), begin % CHUNK + 1, F.when(first == last, end - begin).otherwise(F.lit(CHUNK)))
    middle = F.when(last - first > 1, F.array_join(F.slice(cut, first + 2, F.greatest(last - first - 1, F.lit(0))), "")).otherwise("")
    tail = F.when(last > first, F.substring(F.get(cut, last), F.lit(1), end % CHUNK)).otherwise("")
    return F.when(end > begin, F.concat(head, middle, F.coalesce(tail, F.lit("")))).otherwise("")


def ordered(spans: Column) -> Column:
    """By start, then kind as listed."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.sort_array(keyed)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each, comma-joined in order."""
    return F.array_join(F.transform(ordered(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scores(spans: Column) -> Column:
    """The scores of spans that have one, in the order of ``joined``."""
    keyed = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["score"].alias("score"))))
    return F.array_join(F.transform(keyed, lambda s: s["score"].cast("string")), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def only_digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if a string of decimal digits passes the Luhn check."""
    back = F.split(F.reverse(digits), "")
    value = F.transform(F.filter(back, lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(value, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(iban: Column) -> Column:
    """True if an upper-case IBAN without spaces passes the ISO 7064 mod-97 check."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    code = F.transform(F.filter(F.split(turned, ""), lambda c: c != ""), lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1)
    return F.aggregate(code, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1
