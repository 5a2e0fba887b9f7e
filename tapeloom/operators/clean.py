"""Reader's text: continued lines joined (C1), sentences in paragraphs (W1), paragraphs as text (K8). No shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions import arrays, text


def first_dash_dropped(line: Column) -> Column:
    """Without its first "- ", wherever it stands."""
    at = F.instr(line, "- ")
    return F.when(at > 0, F.concat(F.substring(line, F.lit(1), at - 1), F.substring(line, at + 2, F.length(line)))).otherwise(line)


def clean_lines(c: Column) -> Column:
    """One line of text from many. A line goes on if it begins with "- " or what it follows ends with a comma.

    Flushed lines are simply joined, so all that a line needs to know is whether what is before it ends with
    a comma. A line is a function from that to the same of itself, held as two bits: for no, and for yes.
    These compose, so that their running composition tells it for every line in linear time.
    """

    def bits(line: Column) -> Column:
        # An empty line that goes on leaves two spaces at the end, no comma.
        stays, goes_on = line.endswith(",").cast("int"), first_dash_dropped(line).endswith(",").cast("int")
        return F.when(line.startswith("- "), goes_on).otherwise(stays) + F.lit(2) * goes_on

    # What "p, then q" is, for each p and q.
    both = [sum(((q >> (p >> x & 1)) & 1) << x for x in (0, 1)) for p in range(4) for q in range(4)]

    def then(p: Column, q: Column) -> Column:
        return F.get(F.array(*map(F.lit, both)), p * 4 + q)

    def body(lines: Column, commas: Column) -> Column:
        def one(line: Column, i: Column) -> Column:
            goes_on = line.startswith("- ") | F.coalesce(F.get(commas, i - 1) % 2 == 1, F.lit(False))
            return F.when(goes_on, first_dash_dropped(line)).otherwise(line)

        return F.array_join(F.transform(lines, one), " ")

    # The composition with nothing before is the function that changes nothing.
    joined = arrays.bind(F.split(c, "\n", -1), lambda lines: arrays.bind(arrays.running(F.transform(lines, bits), then, neutral=2), lambda commas: body(lines, commas)))
    return F.concat(joined, F.lit(" "))


def paragraphs(sentences: Column, size: int = 5) -> Column:
    """Sentences in groups of ``size``, the last maybe smaller, each <p>...</p> with a space after each sentence."""
    spaced = F.transform(sentences, lambda s: F.concat(text.strip_browser(s), F.lit(" ")))

    def groups(v: Column) -> Column:
        n = F.ceil(F.size(v) / F.lit(size)).cast("int")
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit("<p>"), F.array_join(F.slice(v, i * size + 1, F.lit(size)), ""), F.lit("</p>")))

    # Bound: a lambda would find the sentences anew for each paragraph.
    return arrays.bind(spaced, lambda v: F.when(F.size(v) > 0, groups(v)).otherwise(F.array().cast("array<string>")))


def reader_html(c: Column, splitter: str = "regex", size: int = 5) -> Column:
    """A text as the reader shows it. The splitter stands in for the browser library's."""
    return F.array_join(paragraphs(text.SPLITTERS[splitter](clean_lines(c)), size), "")


def paragraph_text(html: Column) -> Column:
    """Paragraphs as plain text."""
    return F.replace(F.replace(html, F.lit("<p>"), F.lit("")), F.lit("</p>"), F.lit("\n\n"))


def downloads(rows: DataFrame, html: str = "html") -> DataFrame:
    """K8: what can be downloaded; nothing if it is empty."""
    return rows.withColumn("download", paragraph_text(F.col(html))).where("download <> ''")


def paragraph_rows(rows: DataFrame, keys: list[str], column: str = "text", splitter: str = "regex", size: int = 5) -> DataFrame:
    """W1 as rows (keys, para_no, html)."""
    groups = paragraphs(text.SPLITTERS[splitter](F.col(column)), size)
    return rows.select(*keys, F.posexplode(groups).alias("para_no", "html"))
