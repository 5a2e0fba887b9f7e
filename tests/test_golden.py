"""Cases worked out by hand, and properties."""

import random
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeloom.functions import numbers, text
from tapeloom.operators import clean, merge, naming, segments
from tapeloom.plans import transcripts
from tapeloom.schema import SEGMENT, Settings
from tapeloom.sources import adapters, files, sinks
from tapeloom.streaming import merge as streaming


def each(spark, f, values, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r.y for r in rows.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


SLUGS = {"Hello, World!": "hello_world", " A - B ": "_a_b_", "C++ & C#": "c_c", "a_-_b": "a___b", "!!!": "", "Été 2024": "été_2024"}
BREAKS = {"co-\noperate": "cooperate", "line\nnext": "line next", "line\nNext": "line\nNext", "end.\nnext": "end.\nnext", "7\nnext": "7\nnext", "a\n\nb": "a\n\nb", "mot\nÉté": "mot Été", "tail\n": "tail "}
SENTENCES = {
    "A b. C d! E? f": ["A b", "C d", "E", "f"],
    "see example.com now. ok": ["see example.com now", "ok"],
    "v3.14 is pi.": ["v3.14 is pi"],
    "wait... what": ["wait", "what"],
    "go . com now": ["go", "com now"],
    'he said "Go. Now! Yes" ok': ['he said "Go NowYes" ok'],
    'a "b. c': ['a "b c'],
    "x.com": ["x", "com"],
    "Why?": ["Why?"],
    "": [],
    "...": [],
}


def test_text(spark):
    assert each(spark, text.slug, SLUGS) == list(SLUGS.values())
    assert each(spark, text.repair_breaks, BREAKS) == list(BREAKS.values())
    assert each(spark, text.split_sentences, [*SENTENCES, None]) == [*SENTENCES.values(), None]
    assert [streaming.split_sentences(t) for t in SENTENCES] == list(SENTENCES.values())
    assert each(spark, text.strip, ["\x1c a ", "﻿a"]) == ["a", "﻿a"]
    assert each(spark, text.strip_browser, ["﻿a ", "\x1ca"]) == ["a", "\x1ca"]


def test_strip_is_pythons(spark):
    assert set(text.PYTHON_SPACES) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_split_equals_fold(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(['"', ". ", "! ", "?", ".", "com ", "a", "B", "\n", "-\n", "7", " "]) for _ in range(60)) for _ in range(400)]
    assert each(spark, text.split_sentences, texts) == [streaming.split_sentences(t) for t in texts]
    once = each(spark, text.repair_breaks, texts)
    assert all(len(a) <= len(b) for a, b in zip(once, texts))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet='ab.!?" \n7Z-', max_size=40))
def test_python_splitter_balances_quotes(t):
    found = streaming.split_sentences(t)
    assert all(s.strip() == s and s for s in found)
    assert all(s.count('"') % 2 == 0 for s in found[:-1])


def test_splitting_of_texts_with_the_mark(spark):
    """The characters that splitting uses, in texts: as any other that is no word, space or end."""
    rng = random.Random(3)
    texts = ["".join(rng.choice(["\uffff", "\ufffe", "\ufffe(", "\uffff)", "(", ")", ". ", ".", '"', "a", "B", "\n", "-\n", " "]) for _ in range(30)) for _ in range(300)]
    # Of two characters that no text here has, none has a meaning.
    plain = [t.replace("\uffff", "\u2603").replace("\ufffe", "\u2604") for t in texts]
    want = [[s.replace("\u2603", "\uffff").replace("\u2604", "\ufffe") for s in x] for x in each(spark, text.split_sentences, plain)]
    assert each(spark, text.split_sentences, texts) == want
    assert [streaming.split_sentences(t) for t in texts] == want


THREE = [(1, 0, 0.0, 1.0, "Hello world. How", -0.2), (1, 1, 1.0, 2.0, "are you.", -0.4), (1, 2, 2.0, 3.0, " Fine.", -0.2)]


def test_merge(spark):
    rows = merge.merge_segments(spark.createDataFrame(THREE, SEGMENT))
    got = [tuple(r)[3:8] for r in rows.orderBy("seq", "pos").collect()]
    assert got == [("Hello world", 0, 10, 0.0, 1.0), ("How", 12, 14, 0.0, 1.0), ("are you", 16, 22, 0.0, 2.0), ("are you Fine", 24, 35, 0.0, 3.0)]
    assert [r.model_confidence_score for r in rows.orderBy("seq", "pos").collect()] == pytest.approx([1.0, 1.0, 0.5, 2 / 3])
    assert merge.merged_text(rows).first().merged_text == "Hello world How are you are you Fine "
    assert merge.merge_segments(spark.createDataFrame([], SEGMENT)).count() == 0
    flat = spark.createDataFrame([(*r[:5], -0.5) for r in THREE], SEGMENT)
    assert {r.model_confidence_score for r in merge.merge_segments(flat).collect()} == {0.5}


def test_merge_of_long_transcripts(spark):
    rng = random.Random(2)
    rows = [(i, s, float(s), s + 1.0, "".join(rng.choice(["one ", "two. ", "three! ", 'say "', "four" , " 7."]) for _ in range(8)), -rng.random()) for i in range(3) for s in range(120)]
    df = spark.createDataFrame(rows, SEGMENT)
    got = merge.merge_segments(df)
    for r in got.join(merge.merged_text(got), "transcript_id").collect():
        assert r.merged_text[r.start_char_count : r.end_char_count + 1] == r.sentence
        assert -1e-9 <= r.model_confidence_score <= 1 + 1e-9
    want = []
    for i in range(3):
        carry = ""
        for s in range(120):
            carry += next(r[4] for r in rows if r[0] == i and r[1] == s) + " "
            found = streaming.split_sentences(carry)
            want += [(i, s, p, x) for p, x in enumerate(found)]
            if found:
                carry = found[-1] if len(found) % 2 else ""
    assert [tuple(r)[:4] for r in got.orderBy("transcript_id", "seq", "pos").collect()] == want


def test_clean(spark):
    assert each(spark, clean.clean_lines, ["- Hi,\nthere- x\nBye\n- end", "", "a,- \nb", "a,\n\nb"]) == ["Hi, therex Bye end ", " ", "a,-  b ", "a,  b "]
    seven = [[f"s{i}" for i in range(1, 8)], []]
    html = each(spark, lambda c: F.array_join(clean.paragraphs(c), ""), seven, "array<string>")
    assert html == ["<p>s1 s2 s3 s4 s5 </p><p>s6 s7 </p>", ""]
    assert each(spark, clean.paragraph_text, html) == ["s1 s2 s3 s4 s5 \n\ns6 s7 \n\n", ""]
    assert clean.downloads(spark.createDataFrame([("",), ("<p>a </p>",)], "html string")).count() == 1


def test_names(spark):
    rows = spark.createDataFrame(list(enumerate(["a", "a", "a 1", "a"])), "seq long, title string")
    got = transcripts.named(rows).orderBy("seq").collect()
    assert [r.name for r in got] == ["a", "a_1", "a_1_1", "a_2"]


def test_names_against_one_pass(spark):
    rng = random.Random(3)
    bases = ["".join(rng.choice("ab")) + "".join(rng.choice(["", "_1", "_2", "_1_1"]) for _ in range(2)) for _ in range(400)]
    taken, want = {"a", "b_1", "a_3"}, []
    for b in bases:
        name, n = b, 1
        while name in taken:
            name, n = f"{b}_{n}", n + 1
        taken.add(name)
        want.append(name)
    rows = spark.createDataFrame(list(enumerate(bases)), "seq long, slug string").repartition(5)
    got = naming.allocate(rows, spark.createDataFrame([("a",), ("b_1",), ("a_3",)], "name string")).orderBy("seq").collect()
    assert [r.name for r in got] == want and len(set(want)) == 400


def test_numbers(spark):
    assert each(spark, numbers.round2, [2.675, 0.125, 1.005, None, -0.125], "double") == [2.67, 0.12, 1.0, None, -0.12]
    assert each(spark, numbers.cost, [90.0], "double") == pytest.approx([0.009])
    assert each(spark, numbers.cost_message, [90.0], "double") == ["Audio duration: 1.50 minutes, estimated cost: $0.0090"]


def test_unwanted_goes_from_json_only(spark, tmp_path):
    unwanted = Settings().unwanted_text
    rows = spark.createDataFrame([(1, 0, 0.0, 1.0, " Hi \"x\"\n ", -0.1), (1, 1, 1.0, 2.0, unwanted, -0.2), (1, 2, 2.0, 3.0, unwanted.lower(), -0.3), (20, 0, 0.0, 1.0, "other", -0.1)], SEGMENT)
    sinks.write_all(rows, segments.combined_text(rows), str(tmp_path), unwanted)
    table = files.read_segments_csv(spark, f"{tmp_path}/metadata_csv", "transcript_id", "long").orderBy("transcript_id", "start")
    assert [(r.transcript_id, r.text) for r in table.collect()] == [(1, " Hi \"x\"\n "), (1, unwanted), (1, unwanted.lower()), (20, "other")]
    arrays = files.read_segments_json(spark, f"{tmp_path}/metadata_json", "transcript_id", "long").orderBy("transcript_id", "start")
    assert [(r.transcript_id, r.text) for r in arrays.collect()] == [(1, " Hi \"x\"\n "), (1, unwanted.lower()), (20, "other")]
    assert sorted(tuple(r) for r in files.read_written_texts(spark, f"{tmp_path}/combined_texts", kind="long").collect()) == [(1, f" Hi \"x\"\n  {unwanted} {unwanted.lower()} "), (20, "other ")]
    assert len(list(tmp_path.glob("combined_texts/*/*.txt"))) == len(list(tmp_path.glob("metadata_csv/*/*.csv"))) == len(list(tmp_path.glob("metadata_json/*/*.txt"))) == 2


def test_whole_texts(spark, tmp_path):
    (tmp_path / "a b.txt").write_text("one\n\ntwo\n")
    assert [r.text for r in files.read_texts(spark, str(tmp_path)).collect()] == ["one\n\ntwo\n"]


def test_a_run_transcribes_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    raw = [(1, "/p", "one", b"a. b\nc"), (2, "/p", "", b"x"), (3, "/p", "bad", b"!"), (4, "/p", "empty", b""), (5, "", "x", b"x"), (6, "/p", "two+ 2", b"d")]
    rows = spark.createDataFrame([(*r[:3], bytearray(r[3])) for r in raw], "transcript_id long, path string, filename string, content binary").repartition(3)

    def make():
        model = adapters.line_transcriber()

        def run(content):
            (calls / uuid.uuid4().hex).touch()
            if content == b"!":
                raise ValueError("bad")
            return model(content)

        return run

    run = transcripts.transcribe(rows, make)
    done = run.write(str(tmp_path / "out"))
    assert [tuple(r) for r in done.errors.collect()] == [(3, "ValueError: bad")]
    assert done.sentences.count() == 4 and done.kept.count() == 3
    assert len(list(calls.iterdir())) == 4  # 2 and 5 have no name or no path
    texts = files.read_written_texts(spark, f"{tmp_path}/out/combined_texts", "filename")
    assert sorted(tuple(r) for r in texts.collect()) == [("one", " a. b  c "), ("two+ 2", " d ")]
    assert sorted(r.name for r in files.taken_names(spark, f"{tmp_path}/out/metadata_csv", "filename").collect()) == ["one", "two+ 2"]
    assert adapters.transcribe(rows, make).rdd.getNumPartitions() == rows.rdd.getNumPartitions()
    assert "Exchange" not in adapters.transcribe(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id transcript_id", "cast(text as binary) content"), make, Settings(transcribe_partitions=2))._jdf.queryExecution().toString()


def test_remote_runs(spark, tmp_path):
    raw = [(1, "/p", "one", b"a. b\nc"), (2, "/p", "two", b""), (3, "/p", "bad", b"\xff")]
    rows = spark.createDataFrame([(*r[:3], bytearray(r[3])) for r in raw], "transcript_id long, path string, filename string, content binary")
    run = transcripts.transcribe(rows, adapters.line_client, Settings(use_remote=True)).write(str(tmp_path / "out"))
    assert [tuple(r) for r in run.texts.collect()] == [(1, " a. b c")] and run.sentences.count() == 0
    assert [r.transcript_id for r in run.errors.collect()] == [3]
    assert [r.text for r in run.segments.orderBy("seq").collect()] == [" a. b", " c"]


def test_durations_fail_by_item(spark):
    rows = spark.createDataFrame([(1, bytearray(b"xx")), (2, bytearray(b""))], "i long, content binary")

    def decode(content):
        return 1000 * len(content) / len(content)

    got = sorted(tuple(r) for r in adapters.with_durations(rows, decode).drop("content").collect())
    assert got == [(1, 1.0, None), (2, None, "ZeroDivisionError: division by zero")]


def test_observed_counts(spark):
    rows, seen = segments.observed(spark.createDataFrame(THREE, SEGMENT), "are")
    assert rows.count() == 2
    assert seen.get == {"n_before": 3, "n_removed": 1}


def test_files(spark, tmp_path):
    assert files.taken_names(spark, f"{tmp_path}/none").count() == 0
    for n in ("a.mp4", "b_1.mp4"):
        (tmp_path / n).write_bytes(b"x" * 1048576)
    assert sorted(r.name for r in files.taken_names(spark, str(tmp_path)).collect()) == ["a", "b_1"]
    audio = adapters.with_durations(adapters.with_sizes(files.read_audio(spark, str(tmp_path))), len)
    assert {(r.size_mb, r.duration_s) for r in audio.collect()} == {(1.0, 1048.576)}


def test_response_defaults(spark):
    body = '{"text": "a b", "segments": [{"start": 1.239, "text": "a", "avg_logprob": null}, {"end": null}]}'
    rows = spark.createDataFrame([(7, body), (8, '{"text": ""}'), (9, '{"segments": []}')], "transcript_id long, body string")
    got = sorted(tuple(r) for r in segments.from_response(rows).collect())
    assert got == [(7, 0, 1.239, 0.0, "a", None), (7, 1, 0.0, None, "", 0.0)]
    assert [r.combined_text for r in segments.response_text(rows).orderBy("transcript_id").collect()] == ["a b", "", None]


def test_adapters(spark):
    one, many = adapters.single_video(spark, "t", "u"), adapters.playlist(spark, [("a", "x"), ("b", "y")])
    assert adapters.choose(True, one, many).count() == 1 and adapters.choose(False, one, many).count() == 2
    assert Settings().device(True) == ("cuda", "float16") and Settings(disable_cuda=True).device(True) == ("cpu", "auto")
    raw = spark.createDataFrame([(1, bytearray(b"x")), (2, bytearray(b"")), (3, bytearray(b"!"))], "transcript_id long, content binary")

    def make():
        def run(content):
            if content == b"!":
                raise ValueError("bad")
            return [{"start": 0.125, "text": "t"}] if content else []

        return run

    for remote, start in ((False, 0.12), (True, 0.125)):
        got = sorted(tuple(r) for r in adapters.transcribe(raw, make, Settings(use_remote=remote)).collect())
        assert got == [(1, 0, start, 0.0, "t", 0.0, None), (3, None, None, None, None, None, "ValueError: bad")]


def test_splitters(spark):
    text.register_splitter("lines", text.model_splitter(lambda: lambda t: t.split("|")))
    rows = spark.createDataFrame([(1, "a |b|"), (2, None)], "i int, text string")
    assert [tuple(r) for r in segments.sentences(rows, ["i"], splitter="lines").collect()] == [(1, 0, "a"), (1, 1, "b"), (1, 2, "")]
