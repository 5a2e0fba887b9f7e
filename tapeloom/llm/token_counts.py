"""Operator 7, token counts by section: whole documents are encoded once, tokens dealt to sections by their offsets.

A section is a line with the line break that ends it, so the sections of a text cover it. Token
character spans are interval-joined to section spans by binary search. A token that crosses a
boundary goes by rule: "start", to the section of its first character; "most", to the section with
most of its characters, the earlier one on a tie. Tokens of a text add up to its encoding's length
under either rule.

Defined results: null or empty text is one empty section without tokens; ids, null or repeated, are
carried as they are; an empty table gives no rows; columns other than the id and the text are not
looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tapeloom.llm.common import ship
from tapeloom.llm.tokens import encoder

ship(__name__)

RULES = ("start", "most")


def sections_of(text: str) -> np.ndarray:
    """Starts of the sections and, last, the length of the text."""
    starts, at = [0], text.find("\n")
    while 0 <= at < len(text) - 1:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array([*starts, len(text)], np.int64)


def allocate(bounds: np.ndarray, first: np.ndarray, end: np.ndarray, rule: str = "start") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them cross one of its boundaries."""
    n = len(bounds) - 1
    at = np.searchsorted(bounds[1:-1], first, side="right")
    last = np.searchsorted(bounds[1:-1], np.maximum(end - 1, first), side="right")
    crossing = np.flatnonzero(last > at)
    if rule == "most":
        for k in crossing:
            s = np.arange(at[k], last[k] + 1)
            share = np.minimum(bounds[s + 1], end[k]) - np.maximum(bounds[s], first[k])
            at[k] = s[np.argmax(share)]
    return np.bincount(at, minlength=n), np.bincount(at[crossing], minlength=n)


def count_tokens(docs: DataFrame, rule: str = "start", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, section, start, end, n_tokens, n_crossing); section counts from 0, start and end are characters."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches):
        import pyarrow as pa

        e = encoder()
        for b in batches:
            take, parts = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                t = t or ""
                bounds = sections_of(t)
                n, crossing = allocate(bounds, *e.char_spans(t, e.ids(t)), rule)
                parts.append(np.stack([np.arange(len(n)), bounds[:-1], bounds[1:], n, crossing]))
                take.append(np.full(len(n), i))
            if not take:
                continue
            cols = np.concatenate(parts, 1)
            ids = b.column(0).take(pa.array(np.concatenate(take)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(cols[0].astype(np.int32)), *map(pa.array, cols[1:])], names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"doc_id {kind}, section int, start long, end long, n_tokens long, n_crossing long")
