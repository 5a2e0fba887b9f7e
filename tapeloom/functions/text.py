"""Text functions, Column to Column, all built in.

Null gives null. Character classes follow Python's: white space includes U+001C to U+001F, a word
character is a letter, a number or an underscore.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
SPACE = r"\s\x1c-\x1f"
WORD = r"\p{L}\p{N}_"
#: Ends of sentences: a full stop unless before a common domain name or a digit; any of . ! ? before white space.
SENTENCE_END = rf"(?U)\.(?![{SPACE}]*(?:com|net|org|io)[{SPACE}])(?![0-9])|[.!?][{SPACE}]+"
#: Stands for an end of a sentence. Texts that have it are split with ESCAPES in its place, whose characters no pattern here knows.
MARK = "\uffff"
ESCAPES = {"\ufffe": "\ufffe(", MARK: "\ufffe)"}


#: White space in full, to trim without regular expressions: Python's, and what browsers trim.
_COMMON = "\t\n\x0b\x0c\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
PYTHON_SPACES = _COMMON + "\x1c\x1d\x1e\x1f\x85"
BROWSER_SPACES = _COMMON + "\ufeff"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(PYTHON_SPACES))


def strip_browser(c: Column) -> Column:
    """T12."""
    return F.btrim(c, F.lit(BROWSER_SPACES))


def slug(title: Column) -> Column:
    """A file name from a title."""
    kept = F.regexp_replace(title, rf"(?U)[^{WORD}{SPACE}-]", "")
    return F.lower(strip(F.regexp_replace(kept, rf"(?U)[-{SPACE}]+", "_")))


def join_hyphenated(c: Column) -> Column:
    """A word broken at a line's end by a hyphen."""
    return F.regexp_replace(c, "-\n(?=[a-z])", "")


def join_lines(c: Column) -> Column:
    """A line break after a word that isn't a digit, unless a blank line or a capital follows."""
    return F.regexp_replace(c, rf"(?<=[{WORD}])(?<!\p{{Nd}})\n(?![\nA-Z])", " ")


def repair_breaks(c: Column) -> Column:
    """T2."""
    return join_lines(join_hyphenated(c))


def quotes(c: Column) -> Column:
    """T7."""
    return F.length(c) - F.length(F.replace(c, F.lit('"')))


def escape(c: Column) -> Column:
    for char, instead in ESCAPES.items():
        c = F.replace(c, F.lit(char), F.lit(instead))
    return c


def unescape(c: Column) -> Column:
    for char, instead in reversed(ESCAPES.items()):
        c = F.replace(c, F.lit(instead), F.lit(char))
    return c


def split_sentences(c: Column) -> Column:
    """The sentences of a text, stripped, none blank. Ends inside double quotes join what they part."""
    return F.when(F.contains(c, F.lit(MARK)), F.transform(_split_unmarked(escape(c)), unescape)).otherwise(_split_unmarked(c))


def _split_unmarked(c: Column) -> Column:
    parts = F.split(F.regexp_replace(repair_breaks(c), SENTENCE_END, MARK), '"', -1)
    outside = F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.replace(p, F.lit(MARK))).otherwise(p))
    pieces = F.split(F.array_join(outside, '"'), MARK, -1)
    return F.filter(F.transform(pieces, strip), lambda s: s != "")


def count_pieces(c: Column) -> Column:
    """Pieces that the ends of sentences alone leave."""
    return F.size(F.split(repair_breaks(c), SENTENCE_END, -1))


Splitter = Callable[[Column], Column]

#: Splitters by name. ``register_splitter`` adds one, say around a model in a pandas UDF.
SPLITTERS: dict[str, Splitter] = {"regex": split_sentences}


def register_splitter(name: str, splitter: Splitter) -> None:
    SPLITTERS[name] = splitter


def model_splitter(make_model: Callable[[], Callable[[str], list[str]]]) -> Splitter:
    """T4: a splitter around a model that gives sentences of a text; blank ones are kept. The model is made once a batch run."""
    from collections.abc import Iterator

    import pandas as pd

    def split(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for batch in texts:
            yield batch.map(lambda t: None if t is None else [s.strip() for s in model(t)])

    split.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(split, "array<string>")
    return lambda c: udf(repair_breaks(c))
