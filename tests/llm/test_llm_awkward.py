"""Every registered operator and every stage on tables that hold little or nothing, and on tables
whose extra columns are named like those that the operators make."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
import llm_fixtures as X  # noqa: E402
from palimpsest.llm.queries import QUERIES  # noqa: E402

CLASH = (
    "whole part given budget cap weight tokens n_tokens copies row key id shard row_bytes depth prefix shard_bytes "
    "__domain __lang __source __key __bucket __edge __before f_length f_host_length f_suffix_rate f_section_weight "
    "__url __suffix __section __row __given __slot host path rule verdict label features word c times tail band place "
    "hash sketch digest comp component_id kept n_shingles score predicted spans held_out item_id similarity a b conv pos "
    "name words block items steps range at codes error vector ids decoded agrees").split()
KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id", "embeddings": "vec_id"}
TABLE = {4: "pages", 5: "pages", 10: "pages", 11: "embeddings", 12: "conversations"}
SMALL = {
    "documents": ("doc_id long, text string, lang string, source string, n_chars long", [
        (1, None, "en", "src0", 0), (2, "", "en", None, 0), (3, " \t\n ", None, "src0", 4), (3, " \t\n ", None, "src0", 4),
        (None, None, None, None, None)]),
    "labels": ("doc_id long, quality int, toxic int", [(1, None, None), (None, 1, 1)]),
    "pages": ("page_id long, url string, html string", [
        (1, None, None), (2, "", ""), (None, "http://EXAMPLE.com/x?a=1", "<p>x"), (None, None, None), (2, "", "")]),
    "benchmark": ("item_id long, text string", [(1, None), (None, ""), (2, X.PROSE)]),
    "conversations": ("conv_id long, turn long, role string, text string", [
        (1, None, None, None), (None, 1, "user", "x"), (1, None, None, None)]),
    "embeddings": ("vec_id long, embedding array<float>, label int", [(1, None, 1), (None, [], None), (2, [0.5], None)])}


def write(spark, folder, rows=True, extra=True):
    """The tables, a partition a row; each name of CLASH is a column of theirs unless it has it."""
    for name, (schema, data) in SMALL.items():
        table = spark.createDataFrame(data if rows else [], schema).repartition(len(data))
        if extra:
            table = table.withColumns({c: F.lit(f"x {c}") for c in CLASH if c not in table.columns})
        table.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("odd"))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), rows=False)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_take_empty_texts_no_labels_and_clashing_columns(name, spark, odd):
    number = int(name[2:].split("_")[0])
    rows = QUERIES[name](spark, odd).collect()
    table = TABLE.get(number, "documents")
    if number == 1:
        assert rows == []
    elif number == 12:
        assert rows and {r.conv_id for r in rows} == {1}
    elif number == 11:
        assert sorted((r.vec_id or 0) for r in rows) == [0, 2]
    else:  # a row each, repeated ones too; near duplicates have one an id
        ids = [r[0] for r in SMALL[table][1]]
        got = [r[KEYS[table]] for r in rows]
        assert set(got) == set(ids) and (number == 8 or len(got) == len(ids))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_take_empty_tables(name, spark, empty):
    assert QUERIES[name](spark, empty).collect() == []


def test_toxicity_without_labels_is_undecided(spark, odd):
    assert {(r.score, r.predicted) for r in QUERIES["op2_toxicity"](spark, odd).collect()} == {(0.5, 0)}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_leave_clashing_columns_as_they_are(name, stage, spark):
    extra = {c: F.lit(f"x {c}") for c in CLASH}
    docs = X.documents(spark).drop("shard", "copies", "SCORE").withColumns(extra)
    out = stage(spark, docs, "/root/testdata/sf0.001")
    assert name == "shards" or out.columns == docs.columns
    rows = out.collect()
    made = {"row_bytes", "shard", "depth", "shard_bytes"} if name == "shards" else set()
    assert all(r[c] == f"x {c}" for r in rows for c in set(CLASH) - made)
    before = [r.doc_id for r in docs.collect()]
    assert all(r.doc_id in before for r in rows)


def test_the_pipeline_takes_odd_and_empty_tables(spark, odd, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []
    assert corpus_pipeline.run(spark, odd).count() <= len(SMALL["documents"][1])
