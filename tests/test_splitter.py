"""The learned splitter against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import text
from tapeloom.operators import clean, splitter

PARTS = ["Dr.", "etc.", "U.S.", "e.g.", "word", "The", "end.", "run!", "why?", '"Quoted.', "(see", "p.)", "é.", "3.", "a,b.", "etc.,", "half-\nbroken", "line\nbreak", "\n\n", "...", "x.com", "’tis.", "word.”"]


def texts(n=120):
    rng = random.Random(8)
    return ["".join(rng.choice(PARTS) + rng.choice([" ", " ", "  ", "\n"]) for _ in range(rng.choice([0, 1, 3, 60]))) for _ in range(n)]


def repaired(t):
    return re.sub(r"(?<=[^\W\d])\n(?![\nA-Z])", " ", re.sub(r"-\n(?=[a-z])", "", t))


def bare(t):
    return re.sub("^[(\"'\\[{«“‘]+|[)\"'\\]}»”’]*\\s*$", "", t)


def typed(w):
    w = re.sub("[,;:]+$", "", w)
    return re.sub(r"\.$", "", w).lower(), w.endswith(".")


def brute_model(ts, threshold=splitter.THRESHOLD):
    n, k = Counter(), Counter()
    for t in ts:
        for token in re.findall(r"\S+\s*", repaired(t)):
            w, stop = typed(bare(token))
            if re.fullmatch(r"[^\W\d_][^\W\d_]*(?:[.'’-]|[^\W\d_])*", w):
                n[w] += 1
                k[w] += stop
    usual = sum(k.values()) / max(1, sum(n.values()))
    out = {}
    for w in n:
        if k[w]:
            like = lambda p: k[w] * math.log(p) + ((n[w] - k[w]) * math.log(1 - p) if n[w] > k[w] else 0)
            letters = len(w.replace(".", ""))
            score = 2 * (like(0.99) - like(usual)) * math.exp(-letters) * (len(w) - letters + 1) * letters ** -(n[w] - k[w])
            if score >= threshold:
                out[w] = (n[w], k[w], score)
    return out


def brute_split(t, model):
    out, now = [], ""
    for token in re.findall(r"\S+\s*", repaired(t)):
        now += token
        w = bare(token)
        if re.search(r"[!?]$", w) or (w.endswith(".") and typed(w)[0] not in model):
            out.append(now.strip())
            now = ""
    return out + [now.strip()] if now else out


def test_model_and_splits(spark):
    ts = texts()
    rows = spark.createDataFrame([*enumerate(ts), (-1, None)], "i int, text string")
    model = splitter.learn(rows)
    want = brute_model(ts)
    got = {r.word: (r.n, r.n_stop, r.score) for r in model.collect()}
    assert got.keys() == want.keys() and {"dr", "etc", "e.g", "u.s"} <= got.keys() and "word" not in got
    for w in want:
        assert got[w] == pytest.approx(want[w])
    split = {i: brute_split(t, want) for i, t in enumerate(ts)}
    assert any("Dr. " in s and not s.endswith("Dr.") for x in split.values() for s in x)
    for most in (splitter.MOST_LISTED, 2):  # listed, joined
        found = {i: [] for i in range(len(ts))}
        for r in splitter.split_texts(rows, model, ["i"], most_listed=most).orderBy("i", "pos").collect():
            assert r.pos == len(found[r.i])
            found[r.i].append(r.sentence)
        assert found == split


def test_as_a_splitter(spark):
    text.register_splitter("learned", splitter.splitter(["dr", "e.g"]))
    rows = spark.createDataFrame([("I met Dr. No, e.g. here. Bye! So (he said.) Yes",), ("",), (None,)], "text string")
    got = [r.s for r in rows.select(text.SPLITTERS["learned"](F.col("text")).alias("s")).collect()]
    assert got == [["I met Dr. No, e.g. here.", "Bye!", "So (he said.)", "Yes"], [], None]
    html = rows.select(clean.reader_html(F.col("text"), "learned").alias("h")).first().h
    assert html == "<p>I met Dr. No, e.g. here. Bye! So (he said.) Yes </p>"
    with pytest.raises(ValueError, match="too many"):
        splitter.splitter(["x"] * (splitter.MOST_LISTED + 1))


def test_nothing_to_learn(spark):
    for ts in ([], [None], ["no stop here"], ["a. b. c."]):
        rows = spark.createDataFrame([(t,) for t in ts], "text string")
        model = splitter.learn(rows)
        assert {r.word for r in model.collect()} == set(brute_model([t or "" for t in ts]))
        splitter.split_texts(rows, model, ["text"]).collect()


def test_texts_are_cut_only_where_a_sentence_may_end(spark):
    """Also with the mark of the cuts in the text, odd white space, and blank texts."""
    given = ["A Dr. B.\u2003C!\x1f\x85d. ", f"x{text.MARK}. y \ufffe({text.MARK} z.) W", " \u3000 ", "", "\u00a0'Lead. \u2019 end?”", None]
    rows = spark.createDataFrame([*enumerate(given)], "i int, text string")
    assert [r.n for r in rows.orderBy("i").select(F.size(splitter.pieces(F.col("text"))).alias("n")).collect()][:2] == [4, 3]
    got = {}
    for r in splitter.split_texts(rows, spark.createDataFrame([("dr",)], "word string"), ["i"]).orderBy("i", "pos").collect():
        got.setdefault(r.i, []).append(r.sentence)
    assert got == {i: brute_split(t, {"dr"}) for i, t in enumerate(given) if t and t.strip()}
    # As many rows are looked at as there are distinct words, not as there are words.
    counts = splitter.word_counts(spark.range(1000).select(F.lit("one two. one").alias("text")))
    assert sorted(map(tuple, counts.collect())) == [("one", 2000, 0), ("two", 1000, 1000)]
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2
