"""Operator 8: retrieval against exhaustive scoring, leaks against a scan."""

import numpy as np
from pyspark.core.broadcast import Broadcast

from tapeloom.llm import decontam as D


def brute(docs, items):
    out = set()
    for i, t in docs:
        w = D.plain_words(t)
        for j, x in items:
            size = min(5, len(D.plain_words(x)))
            want = set(zip(*[D.plain_words(x)[k:] for k in range(size)]))
            if want and len(want & set(zip(*[w[k:] for k in range(size)]))) >= 0.8 * len(want):
                out.add((i, j))
    return out


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    x = [(r.item_id, r.text) for r in items.collect()]
    odd = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, x[3][1].upper()), (10**6 + 3, "w " * 90 + x[4][1] + " " + x[5][1] + " w" * 30000), (10**6 + 4, " ".join(x[6][1].split()[:8])), (10**6 + 5, x[7][1])]
    docs = docs.unionByName(spark.createDataFrame(odd + [odd[-1]], "doc_id long, text string")).selectExpr("*", "1 as item_id", "2 as score")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], x)
    rows = D.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(want) > 5
    assert sum(r.doc_id == 10**6 + 5 for r in rows) == 2
    assert {(r.doc_id, r.item_id) for r in D.contaminated(docs, items, most=7).collect()} == want
    kept = D.keep_clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect() if r.doc_id not in {i for i, _ in want})


def test_search_is_exhaustive():
    rng = np.random.default_rng(0)
    items = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 30) % 500)) for i in range(100)] + [(100, "one two three"), (101, "long " + " ".join(f"z{i}" for i in range(150)))]
    index = D.Index(items)
    dense = np.zeros((len(index.vocabulary) + 1, index.n))
    for t in range(len(index.vocabulary)):
        s = slice(index.begin[t], index.begin[t + 1])
        dense[t, index.entry[s]] = index.impact[s]
    assert np.allclose(dense.sum(0), 1) and index.n == 104
    for k in range(300):
        words = items[k % 100][1].split()
        words = words[: int(rng.integers(10, 31))] + [f"w{int(x)}" for x in rng.zipf(1.3, 60) % 500]
        ids = np.array([index.vocabulary.get(w.encode(), len(index.vocabulary)) for w in words])
        score = dense[np.unique(ids)].sum(0)
        for least in (0.1, 0.3, D.THRESHOLD, 0.95):
            got = index.search(ids, least)
            assert [e for e, _ in got] == np.flatnonzero(score >= least - 1e-9).tolist()
            assert np.allclose([s for _, s in got], score[[e for e, _ in got]])
    assert {e for _, e, *_ in index.leaks(["x " * 50 + items[101][1]])} == {101, 102, 103}


def test_many_items():
    """As many items as in a shard: what is found is what exhaustive scoring finds, in full."""
    rng = np.random.default_rng(4)
    draw = lambda n: [f"w{int(x)}" for x in rng.zipf(1.2, n) % 200_000]
    items = [(i, " ".join(draw(int(n)))) for i, n in enumerate(rng.choice([3, 8, 20, 60], D.MOST_ITEMS))]
    index = D.Index(items)
    texts = [" ".join(draw(int(rng.integers(5, 300)))) for _ in range(30)]
    texts += [" ".join(draw(50) + items[k][1].split() + draw(90)) for k in range(0, 20_000, 500)]
    term = np.repeat(np.arange(len(index.vocabulary)), np.diff(index.begin))
    entry, impact = np.frombuffer(index.entry, np.int64), np.frombuffer(index.impact)
    want = set()
    for i, t in enumerate(texts):
        ids = np.array([index.vocabulary.get(w, len(index.vocabulary)) for w in D.plain_words(t)])
        last = max(0, -(-len(ids) // D.HALF) - 1)
        for k in range(max(last, 1)):
            passage = ids[k * D.HALF : (k + 2) * D.HALF]
            has = np.isin(term, passage)
            score = np.bincount(entry[has], impact[has], minlength=index.n)
            reached = np.flatnonzero(score >= D.THRESHOLD - 1e-9).tolist()
            if k == 0:
                assert [e for e, _ in index.search(passage)] == reached
            want |= {(i, e) for e in reached if index.verify(passage, e)}
    assert {(i, e) for i, e, *_ in index.leaks(texts)} == want and len(want) >= 40


def test_rows_in_blocks(monkeypatch):
    """Few postings at a time: passages whose rows come in two blocks are found too."""
    rng = np.random.default_rng(6)
    items = [(i, " ".join(f"w{int(x)}" for x in rng.integers(0, 3000, 40))) for i in range(300)]
    texts = [" ".join(["x"] * int(rng.integers(0, 120)) + items[i][1].split() + ["y"] * int(rng.integers(0, 120))) for i in range(300)]
    index = D.Index(items)
    want = index.leaks(texts)
    assert {(i, index.item[e]) for i, e, *_ in want} >= {(i, i) for i in range(300)}
    for postings in (1, 50, 1000):
        monkeypatch.setattr(D, "POSTINGS", postings)
        assert index.leaks(texts) == want


def test_repeated_items(spark):
    """An item that is there a thousand times is one entry, found a thousand times; which shard it is in does not matter."""
    text = "one two three four five six seven"
    items = spark.createDataFrame([(7, text)] * 1000 + [(None, text)] * 3 + [(8, "other words " * 5)], "item_id long, text string").selectExpr("*", "1 as times")
    docs = spark.createDataFrame([(1, "x " + text), (2, "x y z")], "doc_id long, text string")
    for most in (D.MOST_ITEMS, 1):
        shards, rest = D.shards_of(items, most)
        assert rest.count() == 3
        got = D.contaminated(docs, items, most=most).groupBy("doc_id", "item_id").count().collect()
        assert sorted(map(str, map(tuple, got))) == ["(1, 7, 1000)", "(1, None, 3)"]
        assert [r.doc_id for r in D.keep_clean(docs, items, most=most).collect()] == [2]


def test_short_items():
    index = D.Index([(1, "Forty-two"), (2, "yes"), (3, "one two three four"), (4, "?!"), (5, "")])
    texts = ["it is forty two", "forty and two", "x " * 63 + "forty two", "Yes", "one two three four", "one two three and four", "yes " * 300, "", None]
    assert {(i, index.item[e]) for i, e, *_ in index.leaks(texts)} == {(0, 1), (2, 1), (3, 2), (4, 3), (6, 2)}


def test_lists_are_skipped():
    """Entries that cannot reach the threshold are not scored: of many that share a common word, those with the rare ones are."""
    items = [(i, "the of and " + " ".join(f"r{i}x{k}" for k in range(9))) for i in range(2000)]
    index = D.Index(items)

    class Counted(type(index.impact)):
        reads = 0

        def __getitem__(self, i):
            Counted.reads += 1
            return super().__getitem__(i)

    index.impact = Counted("d", index.impact)
    ids = np.array([index.vocabulary[w.encode()] for w in (items[1234][1] + " " + items[77][1]).split()])
    assert [e for e, _ in index.search(ids)] == [77, 1234] and Counted.reads < 60


def test_one_shard_at_a_time(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(200).selectExpr("*", "1 as shard", "'' as __hash")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    alive, most = set(), 0
    make, destroy = type(spark.sparkContext).broadcast, Broadcast.destroy

    def broadcast(self, value):
        nonlocal most
        b = make(self, value)
        if isinstance(value, D.Index):
            alive.add(id(b))
            most = max(most, len(alive))
            kept.append(b)
        return b

    kept = []
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    monkeypatch.setattr(Broadcast, "destroy", lambda self, blocking=False: (alive.discard(id(self)), destroy(self, blocking)))
    one, clean = D.contaminated(docs, items).collect(), sorted(r.doc_id for r in D.keep_clean(docs, items).collect())
    alive.clear()
    most = 0
    many = D.contaminated(docs, items, most=7).collect()
    assert {(r.doc_id, r.item_id) for r in many} == {(r.doc_id, r.item_id) for r in one}
    left = D.keep_clean(docs, items, most=7)
    assert sorted(r.doc_id for r in left.collect()) == clean and left.columns == docs.columns
    assert most == 1 and not alive and len(kept) > 10


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, None), (3, "a b c d e f"), (3, "x y z")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f")], "item_id long, text string")
    assert sorted((str(r.doc_id), r.item_id) for r in D.contaminated(docs, items).collect()) == [("3", 1)] * 2 + [("None", 1)] * 2
    for most in (D.MOST_ITEMS, 1):
        assert sorted(str(tuple(r)) for r in D.keep_clean(docs, items, most=most).collect()) == ["(3, 'x y z')", "(None, None)"]


def test_scores_do_not_depend_on_shards(spark):
    rng = np.random.default_rng(1)
    x = [" ".join(f"w{int(k)}" for k in rng.zipf(1.4, n) % 300) for n in rng.integers(4, 150, 60)] + [None, "a b", "one two three four five six"]
    items = spark.createDataFrame(list(enumerate(x)), "item_id long, text string")
    texts = [" ".join(w[: int(len(w) * share)]) + " w1 w2 other" for t in x[:60] for share in (0.75, 0.85, 1) if (w := t.split())]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    one, many = ({(r.doc_id, r.item_id, r.question_overlap, r.answer_overlap): r.score for r in D.contaminated(docs, items, most=most).collect()} for most in (D.MOST_ITEMS, 9))
    assert len(one) > 60 and one.keys() == many.keys()
    assert max(abs(one[k] - many[k]) for k in one) < 1e-12
    assert min(one.values()) < 0.9


def test_all_of_an_item_is_indexed():
    for n in [*range(5, 70), 120, 124, 125, 127, 128, 129, 132, 133, 150, 192, 193, 500]:
        for ask in (0, 3, n // 3, n - 2):
            words = [f"v{i}" for i in range(n)]
            index = D.Index([(1, " ".join(words[:ask]) + "? " * (ask > 0) + " ".join(words[ask:]))])
            of = [index.vocabulary[w.encode()] for w in words]
            all_of = D.shingles(of)
            asks, answers = (set().union(*(p[k] for p in index.parts)) for k in (0, 1))
            assert asks | answers == set(all_of) and not asks & answers
            cut = max(1, min(n - 5, (ask or n // 2) - 2))
            assert asks == set(all_of[:cut])
            assert max(len(p[0]) + len(p[1]) for p in index.parts) <= 60
            # Wherever the item stands in a text, all its entries are found.
            got = index.leaks(["x " * (7 * ask) + " ".join(words) + " y" * 99])
            assert [(g[1], *g[3:]) for g in got] == [(e, 1.0, 1.0) for e in range(index.n)]


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, None), (None, "a b c d e f")], "item_id long, text string")
    assert D.contaminated(docs, items.limit(0)).count() == 0
    assert D.contaminated(docs.limit(0), items).count() == 0
    assert [tuple(r)[:2] for r in D.contaminated(docs, items).collect()] == [(1, None)]


def test_a_batch_is_searched_in_parts(monkeypatch):
    """So that a task holds the words of few texts at once; what is found is that of the whole batch."""
    items = [(i, " ".join(f"w{i}x{k}" for k in range(30)) + "? yes it is so here") for i in range(5)]
    texts = [None, "", *(t for i in (3, 0, 4) for t in ("nothing", f"before {items[i][1]} after", "")), "end"]
    index = D.Index(items)
    want = index.leaks(texts)
    held = []
    parts = D.Index._leaks
    monkeypatch.setattr(D.Index, "_leaks", lambda self, some: held.append(sum(len(t or "") for t in some)) or parts(self, some))
    monkeypatch.setattr(D, "TEXTS", 100)
    assert index.leaks(iter(texts)) == want and [f[0] for f in want] == [3, 6, 9]
    assert len(held) >= 3 and max(held) <= 100 + max(len(t or "") for t in texts)
