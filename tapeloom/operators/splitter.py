"""A sentence splitter that learns abbreviations from the texts themselves, without labels.

After Kiss and Strunk (2006), "Unsupervised multilingual sentence boundary detection": a word that nearly
always has a full stop is an abbreviation, and its stop ends no sentence. For each word the likelihood of its
stops under "as often as any word" is compared with "nearly always"; the log ratio is scaled up for inner
stops and down for length and for each time that the word has no stop. Counts and scores are Spark aggregates;
the words above the threshold are the model.

A model of up to ``MOST_LISTED`` words goes into the plan as a literal; a larger one is joined: the words with
stops of each text meet the model by word, and what a text has of it travels back by the text's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions import arrays, text

#: Of a word that is an abbreviation, the share of its occurrences that have a stop; the score from which a word counts as one.
SURE, THRESHOLD = 0.99, 0.3
#: Words that a plan holds as a literal, some hundred kilobytes.
MOST_LISTED = 10_000
#: White space as Python has it, as ranges, which Java's patterns tell quickly.
_GAP = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
OPENING, CLOSING = "(\"'[{«“‘", ")\"']}»”’"
WORD = r"^\p{L}[\p{L}.'’-]*$"


#: A place where a sentence may end: a mark that ends a word, and the white space after it.
MAY_END = rf"([.!?][)\"'\]}}»”’]*[{_GAP}]+)"


def _spaced(c: Column) -> Column:
    return F.translate(c, text.PYTHON_SPACES, " " * len(text.PYTHON_SPACES))


def words(c: Column) -> Column:
    """Words, each with what is around it but white space."""
    return F.filter(F.split(_spaced(c), " "), lambda x: x != "")


def pieces(c: Column) -> Column:
    """A text cut wherever a sentence may end, white space and all; blank pieces are dropped."""

    def cut(x: Column) -> Column:
        return F.split(F.regexp_replace(x, MAY_END, f"$1{text.MARK}"), text.MARK)

    parts = F.when(F.contains(c, F.lit(text.MARK)), F.transform(cut(text.escape(c)), text.unescape)).otherwise(cut(c))
    return F.filter(parts, lambda x: text.strip(x) != "")


def last_word(piece: Column) -> Column:
    return F.substring_index(F.rtrim(_spaced(piece)), " ", -1)


def bare(token: Column) -> Column:
    """A word without white space, and without brackets and quotes around it."""
    return F.ltrim(F.rtrim(F.rtrim(token, F.lit(text.PYTHON_SPACES)), F.lit(CLOSING)), F.lit(OPENING))


def may_end(token: Column, marks: str) -> Column:
    """Whether one of ``marks`` ends the word."""
    return F.right(bare(token), F.lit(1)).isin(*marks)


def _plain(word: Column) -> Column:
    return F.rtrim(word, F.lit(",;:"))


def _type(word: Column) -> Column:
    """A word in lower case without its last full stop."""
    plain = _plain(word)
    return F.lower(F.when(plain.endswith("."), F.substring(plain, F.lit(1), F.length(plain) - 1)).otherwise(plain))


def word_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    """(word, n, n_stop) over all words of all texts; a word is letters, maybe with stops, hyphens and apostrophes."""
    # Equal words are counted first: few are left to be looked at.
    raw = texts.select(F.explode(words(text.repair_breaks(F.col(column)))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    trimmed = raw.select(bare(F.col("token")).alias("bare"), "n")
    typed = trimmed.select(_type(F.col("bare")).alias("word"), _plain(F.col("bare")).endswith(".").alias("stop"), "n")
    n_stop = F.sum(F.when(F.col("stop"), F.col("n")).otherwise(0))
    return typed.where(F.col("word").rlike(WORD)).groupBy("word").agg(F.sum("n").alias("n"), n_stop.alias("n_stop"))


def scored(counts: DataFrame) -> DataFrame:
    """Counts with ``score``; null for words that never have a stop. The totals are one row."""
    totals = counts.agg((F.sum("n_stop") / F.sum("n")).alias("usual"))
    plain, letters = F.col("n") - F.col("n_stop"), F.length(F.replace("word", F.lit("."), F.lit("")))

    def likelihood(p: Column) -> Column:
        # No occurrence, no factor, also where its probability is none.
        return F.col("n_stop") * F.ln(p) + F.when(plain > 0, plain * F.ln(1 - p)).otherwise(0.0)

    ratio = 2 * (likelihood(F.lit(SURE)) - likelihood(F.col("usual")))
    inner = F.length("word") - letters + 1
    score = ratio * F.exp(-letters.cast("double")) * inner * F.pow(letters.cast("double"), -plain.cast("double"))
    return counts.join(F.broadcast(totals)).select("word", "n", "n_stop", F.when(F.col("n_stop") > 0, score).alias("score"))


def learn(texts: DataFrame, column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The model: rows (word, n, n_stop, score) of the abbreviations."""
    return scored(word_counts(texts, column)).where(F.col("score") >= threshold)


def _stops(last: Column) -> Column:
    """Of the pieces' last words those that have a full stop."""
    return F.transform(F.filter(last, lambda t: may_end(t, ".")), lambda t: _type(bare(t)))


def _split(c: Column, known: Column) -> Column:
    """Sentences of a text whose page breaks are repaired; ``known``: the abbreviations that it may have."""

    def ends(last: Column, here: Column) -> Column:
        def one(t: Column) -> Column:
            return F.when(~may_end(t, ".!?"), False).otherwise(may_end(t, "!?") | ~F.array_contains(here, _type(bare(t))))

        return F.transform(last, one)

    def cut(all_pieces: Column, flags: Column) -> Column:
        n = F.size(all_pieces)
        # Places after which a sentence ends; the text's end is one.
        last = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | F.get(flags, i - 1))
        whole = arrays.bind(last, lambda at: F.transform(at, lambda e, i: text.strip(F.array_join(F.slice(all_pieces, F.coalesce(F.get(at, i - 1), F.lit(0)) + 1, e - F.coalesce(F.get(at, i - 1), F.lit(0))), ""))))
        return F.when(n > 0, whole).otherwise(F.array().cast("array<string>"))

    def body(all_pieces: Column) -> Column:
        # Few of the model's words are in a text: they are found once, by hashing.
        return arrays.bind(F.transform(all_pieces, last_word), lambda last: arrays.bind(F.array_intersect(_stops(last), known), lambda here: arrays.bind(ends(last, here), lambda flags: cut(all_pieces, flags))))

    return F.when(c.isNotNull(), arrays.bind(pieces(c), body))


def splitter(abbreviations: list[str]) -> text.Splitter:
    """A splitter for ``text.register_splitter`` that knows these words."""
    if len(abbreviations) > MOST_LISTED:
        raise ValueError(f"{len(abbreviations)} words are too many for a plan: use split_texts")
    known = F.array(*map(F.lit, abbreviations)).cast("array<string>")
    return lambda c: _split(text.repair_breaks(c), known)


def split_texts(texts: DataFrame, model: DataFrame, keys: list[str], column: str = "text", most_listed: int = MOST_LISTED) -> DataFrame:
    """Rows (keys, pos, sentence) of all texts; ``keys`` tell texts apart. The model is listed if it is small, else joined."""
    listed = [r.word for r in model.select("word").orderBy("word").limit(most_listed + 1).collect()]
    whole = texts.select(*keys, text.repair_breaks(F.col(column)).alias("whole"))
    if len(listed) <= most_listed:
        split = _split(F.col("whole"), F.array(*map(F.lit, listed)).cast("array<string>"))
    else:
        met = whole.select(*keys, F.explode(F.array_distinct(_stops(F.transform(pieces(F.col("whole")), last_word)))).alias("word")).join(model.select("word"), "word")
        here = met.groupBy(*keys).agg(F.collect_set("word").alias("known"))
        whole = whole.join(here, keys, "left")
        split = _split(F.col("whole"), F.coalesce("known", F.array().cast("array<string>")))
    return whole.select(*keys, F.posexplode(split).alias("pos", "sentence"))
