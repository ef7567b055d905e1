"""Stages of the corpus pipeline: columns, whole results, and each decision against its operator's brute force."""

import corpus_pipeline as cp
from tests.llm.test_ngram_join import brute as join_brute
from tests.llm.test_spans import brute as spans_brute


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").collect()}
    rows = {r.doc_id: r.text for r in docs.collect()}

    first = cp.reject_toxic(spark, docs, sf_dir).cache()
    assert first.columns == columns
    kept = {r.doc_id for r in first.collect()}
    labelled = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len((labelled - toxic) - kept) <= 0.02 * len(labelled - toxic)

    second = cp.drop_near_duplicates(spark, first, sf_dir).cache()
    truth = {c for _, _, c in join_brute([(i, rows[i]) for i in kept], cp.SHINGLE_WORDS, cp.SIMILAR_PERCENT)}
    assert second.columns == columns and sorted(r.doc_id for r in second.collect()) == sorted(truth)

    third = cp.cut_repeated_passages(spark, second, sf_dir).cache()
    left = spans_brute([(r.doc_id, r.text) for r in second.collect()])
    got = third.collect()
    assert third.columns == columns
    assert sorted((r.doc_id, r.text) for r in got) == sorted((d, out[0]) for (d, _), out in left.items())
    assert all(r.n_chars == len(r.text) for r in got)

    fourth = cp.drop_benchmark_leaks(spark, third, sf_dir).cache()
    items = [" ".join(r.text.split()).lower() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    held = {r.doc_id for r in fourth.collect()}
    for r in got:
        if any(item in " ".join(r.text.split()).lower() for item in items):
            assert r.doc_id not in held
    assert fourth.columns == columns and len(held) >= 0.9 * len(got)

    last = {r.doc_id: r for r in cp.encode_tokens(spark, fourth, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in fourth.collect()}
    assert {i: r.text for i, r in last.items()} == texts
    assert all(r.n_tokens == len(r.token_ids) for r in last.values())


def test_odd_documents(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int, component_id long, row string"
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(1, None), (2, ""), (None, "a b c d e f"), (4, long), (5, long), (4, long), (None, "a b c d e f"), (6, "plain text"), (7, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 1, 2, "r") for i, t in rows], schema)
    for stage in (cp.reject_toxic, cp.cut_repeated_passages, cp.drop_benchmark_leaks):
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() == len(rows)
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    kept = cp.drop_near_duplicates(spark, docs, sf_dir)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 2, None, 4, 6, 7], key=repr)
    assert cp.drop_near_duplicates(spark, docs.limit(0), sf_dir).count() == 0
    coded = cp.encode_tokens(spark, docs, sf_dir)
    assert coded.count() == len(rows) and {r.text for r in coded.where("doc_id in (1, 2)").collect()} == {""}


def test_run_is_the_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
    whole = sorted((r.doc_id, r.text) for r in cp.run(spark, sf_dir).collect())
    assert whole == sorted((r.doc_id, r.text) for r in docs.collect()) and whole
