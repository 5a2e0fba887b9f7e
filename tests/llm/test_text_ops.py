"""Operators 2, 3 and 7 against plain Python."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import public_tokenizers
from tokenizers import Tokenizer

from tapeloom.llm import packing, quality, queries, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n ", "a", "a b c a b c a b c", "x\nx\n\nx\n \n \n", "#*$%&|<> é😀", "w " * 30000, "<|endoftext|> hi<|endoftext|>", "🙂🙂 naïve\n\n\n  tail \n", "the " * 100 + "the"]


def with_odd(spark, sf_dir):
    odd = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(ODD)] + [(10**6 + 3, "a"), (None, "n")], "doc_id long, text string")
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(odd).selectExpr("*", "1 as length", "2 as n_words", "3 as salt")


def brute_stats(text):
    text = text or ""
    words = WORD.findall(text)
    at = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if at[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again)


def test_quality(spark, sf_dir):
    docs, labels = with_odd(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = quality.quality_report(docs, labels).collect()
    want = Counter((i, *brute_stats(t)) for i, t in texts)
    assert Counter(tuple(r)[:6] for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.kept)
    quality_of = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(quality_of[r.doc_id], r.kept) for r in rows if r.doc_id in quality_of and not r.base_failed]
    assert np.mean([k for q, k in judged if q == 1]) > 0.97
    assert np.mean([k for q, k in judged if q == 0]) < 0.2


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, " ".join(map(str, range(60)))), (2, "x")], "doc_id long, text string")
    none = spark.createDataFrame([(None, 0, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.kept for r in quality.quality_report(docs, none).collect()} == {1: True, 2: False}
    assert quality.quality_report(docs.limit(0), none).count() == 0


def test_what_is_learned_from(spark, monkeypatch):
    """Of documents that share a labelled id always the same one, whatever their order; labels without documents take no places."""
    seen = []
    monkeypatch.setattr(quality, "learn", lambda x, bad: seen.append((x.tolist(), bad.tolist())) or [])
    texts = [(i % 7, f"word{i} " * (5 + i)) for i in range(60)] + [(3, None)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(-300, 300)], "doc_id long, quality int, toxic int")
    for order in (texts, texts[::-1], sorted(texts, key=lambda t: str(t[1])[-9:])):
        quality.train(spark.createDataFrame(order, "doc_id long, text string").repartition(5), labels, most=7)
    assert seen[0] == seen[1] == seen[2] and len(seen[0][1]) == 7
    seen.clear()
    quality.train(spark.createDataFrame(texts, "doc_id long, text string"), labels, most=4)
    assert len(seen[0][1]) == 4


def test_decision_list_held_out():
    rng = np.random.default_rng(1)
    x = rng.random((6000, len(quality.FEATURES)))
    bad = (x[:, 0] > 0.7) & (x[:, 2] < 0.5) | (x[:, 4] > 0.9)
    rules = quality.learn(x[:3000], bad[:3000])
    got = np.zeros(3000, bool)
    for r in rules:
        got |= quality._covers(r, x[3000:])
    assert (got == bad[3000:]).mean() > 0.97


def test_decision_list_held_out_on_labels():
    """Learned on two thirds of the given labels, judged on the rest."""
    d = "/root/testdata/sf0.1"
    label = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{d}/labels.parquet").to_pylist()}
    rows = [(quality.stats_of(r["text"]), label[r["doc_id"]] == 0) for r in pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"]).to_pylist() if r["doc_id"] in label]
    x, bad = quality.matrix([dict(zip(quality.NAMES, r[0])) for r in rows]), np.array([r[1] for r in rows])
    test = np.random.default_rng(0).random(len(rows)) < 1 / 3
    fired = np.zeros(int(test.sum()), bool)
    rules = quality.learn(x[~test], bad[~test])
    for r in rules:
        fired |= quality._covers(r, x[test])
    assert 2 <= len(rules) and bad[test][fired].mean() > 0.95 and fired[bad[test]].mean() > 0.9 and fired[~bad[test]].mean() < 0.01


def test_decision_list_goes_on_after_a_failure():
    """What cannot be told apart does not keep the learner from what can."""
    rng = np.random.default_rng(3)
    x = rng.random((9000, len(quality.FEATURES)))
    noise, clear = x[:, 0] > 0.6, x[:, 3] > 0.97
    bad = noise & (rng.random(9000) < 0.6) | clear
    rules = quality.learn(x, bad)
    got = np.zeros(9000, bool)
    for r in rules:
        got |= quality._covers(r, x)
    assert got[clear].mean() > 0.9 and bad[got].mean() > 0.9


def encode(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return t.encode_batch(texts, add_special_tokens=False)


def check_packing(docs, rows, size=1024):
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = Counter()
    for (i, _), e in zip(texts, encode([t for _, t in texts])):
        ids = np.array([*e.ids, 2], "<u4")
        first = len(ids) if len(ids) <= size else len(ids) % size or size
        starts = [0, *range(first, len(ids), size)]
        for p, (s, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want[i, p, s, end - s, zlib.crc32(ids[s:end].tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in by.values():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n
        assert at <= size
    return len(by), sum(r.length for r in rows)


def test_packing(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 7)
    docs = with_odd(spark, sf_dir)
    n, total = check_packing(docs, packing.pack(docs).collect())
    assert n <= -(-total // 1024) * 1.01
    assert packing.pack(docs.limit(0)).count() == 0


def test_plan_uses_exact_complements():
    assert packing.plan({600: 2, 424: 1, 300: 1, 124: 1}) == [((600, 424), 1), ((600, 300, 124), 1)]
    assert packing.plan({1000: 1, 8: 3}) == [((1000, 8, 8, 8), 1)]
    assert sum(k for _, k in packing.plan({512: 5})) == 3


def test_token_counts(spark, sf_dir):
    docs = with_odd(spark, sf_dir).where("doc_id is not null and doc_id <> 1000003")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    spans = dict(zip(texts, encode(list(texts.values()))))
    for rule in token_counts.RULES:
        got = {}
        for r in token_counts.count_tokens(docs, rule).collect():
            got[r.doc_id, r.section] = (r.start, r.end, r.n_tokens)
        for i, t in texts.items():
            bounds, at = [], 0
            for line in t.split("\n"):
                bounds.append((at, min(at + len(line) + 1, len(t))))
                at += len(line) + 1
            if len(bounds) > 1 and bounds[-1][0] == bounds[-1][1]:
                bounds.pop()
            n = [0] * len(bounds)
            for a, b in spans[i].offsets:
                share = [min(e, b) - max(s, a) for s, e in bounds]
                n[max(range(len(n)), key=lambda k: share[k]) if rule == "most" else next(k for k, (s, e) in enumerate(bounds) if s <= a < e)] += 1
            assert [got[i, k] for k in range(len(bounds))] == [(*b, c) for b, c in zip(bounds, n)], i
        assert len(got) == sum(1 for _ in got)


def test_token_counts_of_odd_rows(spark):
    texts = [(None, "a b\nc"), (None, None), (3, "a b\nc"), (3, "a b\nc"), (3, "other"), (4, ""), (5, "x" * 200_000 + "\n" + "y z " * 50_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 section", "2 start", "3 end", "4 n_tokens", "5 row")
    rows = token_counts.count_tokens(docs).collect()
    of = {t: len(e.ids) for t, e in zip(("a b\nc", "other", texts[-1][1]), encode(["a b\nc", "other", texts[-1][1]]))}
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.n_tokens
    assert total == {None: of["a b\nc"], 3: 2 * of["a b\nc"] + of["other"], 4: 0, 5: of[texts[-1][1]]}
    assert Counter((r.doc_id, r.section) for r in rows if r.doc_id == 3) == {(3, 0): 3, (3, 1): 2}


def test_packing_of_one_id(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 7)
    docs = spark.createDataFrame([(7, f"text {i} " + "w " * (i % 5)) for i in range(300)] + [(None, f"n {i}") for i in range(300)], "doc_id long, text string")
    check_packing(docs, packing.pack(docs).collect())


def test_crossing_rule():
    bounds, first, end = np.array([0, 2, 5, 9]), np.array([0, 1, 4, 6]), np.array([1, 5, 6, 9])
    assert [x.tolist() for x in token_counts.allocate(bounds, first, end, "start")] == [[2, 1, 1], [1, 1, 0]]
    assert [x.tolist() for x in token_counts.allocate(bounds, first, end, "most")] == [[1, 2, 1], [0, 2, 0]]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(none).count() == 0


def test_queries_over_small_tables(spark, small_dir):
    for name in ("op1_secret_scan", "op2_quality_rules", "op4_pii"):
        assert queries.QUERIES[name](spark, small_dir).count() == 200


def test_complements_go_on_when_counts_run_out():
    from itertools import combinations_with_replacement

    # The longest piece is in use: 224 beside another 400 does not count.
    counts = {400: 1, 330: 1, 312: 2, 224: 1}
    assert ((400, 312, 312), 1) in packing.plan_to(counts, 1024, 2)
    # One 250 is left: (250, 250, 124) is out, (250, 187, 187) is not.
    assert packing.Complements({250: 1, 187: 2, 124: 1}).triple(624) == (250, 187, 187)
    for seed in range(200):
        rng = np.random.default_rng(seed)
        counts = {int(n): int(rng.integers(1, 4)) for n in rng.integers(1, 25, 7)}
        c, gap = packing.Complements(counts), int(rng.integers(2, 50))
        for k, got in enumerate((c.single(gap), c.pair(gap), c.triple(gap)), 1):
            can = [x for x in combinations_with_replacement(counts, k) if sum(x) == gap and c.times(x)]
            assert bool(got) == bool(can) and (not got or sum(got) == gap and c.times(got))
        for depth in range(4):
            used = {}
            for combo, times in packing.plan_to(counts, 32, depth):
                assert sum(combo) <= 32 and times > 0
                for n in combo:
                    used[n] = used.get(n, 0) + times
            assert used == counts
