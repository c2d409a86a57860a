"""Registered training-data queries against their SQL, and the pipeline against brute force."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
import llm_fixtures as X  # noqa: E402
from harness import compare, connect  # noqa: E402
from palimpsest.llm.common import read  # noqa: E402
from palimpsest.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(name, spark, sf):
    result = compare(spark, connect(sf), QUERIES[name], ORACLE[name], sf)
    assert result["columns"] and not result["types"] and result["equal"], result


@pytest.mark.parametrize("name, key", [
    ("op2_toxicity", "doc_id"), ("op5_url_filter", "page_id"), ("op9_lm_score", "doc_id"),
    ("op10_html_text", "page_id")])
def test_other_queries_give_a_row_each(name, key, spark, sf):
    rows = QUERIES[name](spark, sf).collect()
    table = "pages" if key == "page_id" else "documents"
    assert sorted(r[key] for r in rows) == sorted(r[key] for r in read(spark, sf, table).collect())


def test_leaks_of_the_test_tables(spark, sf):
    docs = [(r.doc_id, r.text) for r in read(spark, sf, "documents").filter("length(text) < 3000").collect()]
    items = [(r.item_id, r.text) for r in read(spark, sf, "benchmark").collect()]
    some = {i for i, _ in docs}
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start_word)
           for r in QUERIES["op1_decontamination"](spark, sf).collect() if r.doc_id in some}
    assert got == X.leaks(docs, items)


def test_there_is_one_query_of_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


def test_stages_keep_what_they_should(spark, sf):
    docs = read(spark, sf, "documents")
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        after = out.collect()
        ids = {r.doc_id for r in after}
        assert after and ids <= {r.doc_id for r in before}
        if name != "shards":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        if name == "near":
            groups = X.near_groups([(r.doc_id, r.text) for r in before], 80)
            assert ids == set(groups.values())
        if name == "benchmark":
            items = [(r.item_id, r.text) for r in read(spark, sf, "benchmark").collect()]
            texts = [(r.doc_id, r.text) for r in before if len(r.text) < 3000]
            assert {i for i, _ in X.leaks(texts, items)} == {i for i, _ in texts} - ids
        if name == "shards":
            assert ids == {r.doc_id for r in before}
        docs, before = spark.createDataFrame(after, out.schema), after
    assert corpus_pipeline.run(spark, sf).count() == len(before)


def test_stages_take_odd_and_empty_tables(spark, sf):
    odd = X.documents(spark).drop("shard", "copies", "SCORE")
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, sf).count() <= docs.count()
