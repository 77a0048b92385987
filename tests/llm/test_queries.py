"""The registered queries and the pipeline on the smallest test data."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from larder.llm.queries import ORACLES, QUERIES
from tools.check_oracles import connect, difference

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_a_row_for_each_document(spark, name):
    if name in ORACLES:
        assert difference(spark, connect(SF), SF, name) is None
        return
    rows = QUERIES[name](spark, SF)
    if name.startswith("op11_"):
        conversations = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().collect()
        assert sorted(r[0] for r in rows.select("conv_id").collect()) == sorted(r[0] for r in conversations)
        return
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    if name.startswith("op9_"):
        assert rows.join(documents, "doc_id", "left_anti").count() == 0
    else:
        assert sorted(r[0] for r in rows.select("doc_id").collect()) == sorted(r[0] for r in documents.select("doc_id").collect())


def test_stages_keep_columns_and_only_remove_or_repeat(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        assert set(corpus_pipeline.COLUMNS) <= set(after.columns)
        for row in after.collect():
            assert before[row["doc_id"]]["text"] == row["text"]
        if name not in ("source mixing", "sharding"):
            assert after.count() == after.select("doc_id").distinct().count()
        docs = after.select(*corpus_pipeline.COLUMNS) if name != "sharding" else after
    slots = docs.groupBy("shard").agg({"slot": "max", "doc_id": "count"}).collect()
    assert all(r["max(slot)"] + 1 == r["count(doc_id)"] for r in slots)


def test_stages_handle_empty_and_null_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    empty = spark.createDataFrame([], schema)
    nulls = spark.createDataFrame([(None, None, None, None, None), (1, "", None, "s", 0), (1, "", None, "s", 0)], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
        assert stage(spark, nulls, SF).count() <= 9


def test_decontamination_of_rows_without_id_goes_by_their_text(spark):
    passage = max((r["text"] or "" for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=len)
    texts = [(None, passage), (None, passage), (None, "clean"), (None, "clean"), (None, None), (1, "clean"), (2, passage)]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.decontamination_stage(spark, frame, SF).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept) == [("1", "clean"), ("None", "None"), ("None", "clean"), ("None", "clean")]
