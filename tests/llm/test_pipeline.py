"""The pipeline, stage by stage, against plain Python where a stage's rule is exact."""

from test_decontam import brute as brute_leaks
from test_simhash import brute_components, brute_fp
from test_spans import PII_RE, HOLDS
from test_text_ops import brute_stats, check_packing

import corpus_pipeline


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        rows = out.collect()
        ids = {r.doc_id for r in rows}
        if k < 4:
            assert out.columns == columns
        if name == "quality_rules":
            failed = {r.doc_id for r in before if (s := brute_stats(r.text))[0] < 50 or 100 * s[4] > 50 * s[0]}
            assert not ids & failed
            good = {r.doc_id for r in before if labels.get(r.doc_id) == 1} - failed
            assert len(good - ids) <= 0.03 * len(good)
        elif name == "simhash_dedup":
            want = set(brute_components([r.doc_id for r in before], [brute_fp(r.text) for r in before]))
            assert ids == want and len(rows) == len(want)
        elif name == "decontaminate":
            leaked = {i for i, _ in brute_leaks([(r.doc_id, r.text) for r in before], items)}
            assert ids == {r.doc_id for r in before} - leaked
        elif name == "redact_pii":
            assert ids == {r.doc_id for r in before}
            assert not any(HOLDS[kind](m) for r in rows for kind, rx in PII_RE.items() for m in rx.finditer(r.text))
            assert all(r.n_chars == len(r.text) for r in rows)
        else:
            n, total = check_packing(docs, rows)
            assert n <= -(-total // 1024) * 1.02
        docs = out
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count()


def test_odd_rows(spark, small_dir, tmp_path):
    """Null ids and texts, repeated rows, a very long text, columns that clash with those of the operators."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    text = " ".join(f"some{i} word{i}" for i in range(60))
    odd = [(None, text, 1), (None, text, 2), (10**6, text + " more", 3), (10**6 + 1, None, 4), (10**6 + 2, "", 5), (10**6 + 3, " ".join(f"long{i}" for i in range(150_000)), 6), (10**6 + 4, "call mail a@b.co " + " ".join(f"other{i}" for i in range(90)), 7)]
    odd = spark.createDataFrame(odd, "doc_id long, text string, n_chars long").selectExpr("doc_id", "text", "'en' lang", "'s' source", "n_chars")
    whole = docs.unionByName(odd.unionByName(odd.where("n_chars = 7"))).selectExpr("*", "1 length", "2 found", "3 kept", "4 n_words", "5 fp", "6 piece", "7 __found")
    whole.write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{small_dir}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, str(tmp_path))
        assert out.columns == whole.columns
        out.write.parquet(f"{tmp_path}/{name}")
        rows = spark.read.parquet(f"{tmp_path}/{name}")
    ids = [r.doc_id for r in rows.select("doc_id").collect()]
    assert ids.count(10**6) + ids.count(None) == 1 and ids.count(10**6 + 3) == 1 and ids.count(10**6 + 4) == 1
    assert not {10**6 + 1, 10**6 + 2} & set(ids)
    assert rows.where(f"doc_id = {10**6 + 4}").first().text.startswith("call mail <EMAIL> other0")
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.select("doc_id", "length").distinct().count() > 0 and {r.doc_id for r in packed.collect()} == set(ids)
    none = tmp_path / "none"
    for t, df in (("documents", docs.limit(0)), ("labels", spark.read.parquet(f"{small_dir}/labels.parquet")), ("benchmark", spark.read.parquet(f"{small_dir}/benchmark.parquet"))):
        df.write.parquet(f"{none}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(none)).count() == 0
