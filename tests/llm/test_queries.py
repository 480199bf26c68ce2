"""The registered queries against their SQL, and the pipeline stage by stage."""

import os

import pytest

import corpus_pipeline
from ticketmill.catalog.check import compare, connect
from ticketmill.llm import decontaminate, queries, simhash

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    if name in queries.ORACLES:
        assert compare(spark, connect(SF), SF, queries.QUERIES[name], queries.ORACLES[name]) == ""
    else:
        rows = queries.QUERIES[name](spark, SF).count()
        assert rows >= (50 if name == "op2_html_region" else 200)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.settle(stage(spark, docs, SF), name)
        assert docs.columns == before.columns == list(corpus_pipeline.COLUMNS)
        assert docs.dtypes == before.dtypes
        sizes.append(docs.count())
        if name == "near_duplicates":
            want = {r["component_id"] for r in simhash.groups(before).collect()}
            assert {r["doc_id"] for r in docs.collect()} == want
        if name == "decontamination":
            hit = decontaminate.contaminated(before, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("n_hit > 0")
            gone = {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in docs.collect()}
            assert gone == {r["doc_id"] for r in hit.collect()}
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 100
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).select("doc_id").distinct()
    assert packed.count() == sizes[-1]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()} == {r["doc_id"] for r in packed.collect()}


def test_pipeline_on_odd_rows(spark, tmp_path):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "the cat and the dog of it", "en", "s", 25),
            (4, "the cat and the dog of it", "en", "s", 25), (None, "le chat et la de les", "fr", "s", 9), (5, "le chat et la de les une", "fr", None, 24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {3, 5}
    docs.limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
