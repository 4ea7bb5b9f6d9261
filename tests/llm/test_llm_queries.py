"""Registered queries of the subpackage beside their SQL, and the pipeline's stages against plain versions."""

import re

import pytest

import corpus_pipeline
from compare import compare, duck
from matricula.llm.catalog import LLM_QUERIES, LLM_SQL
from messy import DE, EN, cases, documents, rows_of
from test_sets import plain_groups, plain_hits
from test_texts import plain_pii


def test_names():
    assert [n.split("_")[0] for n in LLM_QUERIES] == [*(f"op{i}" for i in range(1, 14)), "pipeline"] and set(LLM_SQL) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query(spark, raw_dir, name):
    assert compare(LLM_QUERIES[name](spark, raw_dir), duck(raw_dir), LLM_SQL[name]) is None


def test_stages_one_by_one(spark, raw_dir):
    import duckdb

    docs = spark.read.parquet(f"{raw_dir}/documents.parquet")
    bench = duckdb.sql(f"SELECT item_id, text FROM '{raw_dir}/benchmark.parquet'").fetchall()
    stages = dict(corpus_pipeline.STAGES)
    first = corpus_pipeline.stored(stages["language"](spark, docs, raw_dir), "t")
    assert first.columns == docs.columns and first.count() == docs.where("text rlike '[a-zA-Zà-ÿ]'").count()
    second = corpus_pipeline.stored(stages["near_duplicates"](spark, first, raw_dir), "t")
    groups = plain_groups([(r["doc_id"], r["text"]) for r in first.collect()], 5, 80)
    assert rows_of(second, "doc_id") == [(i,) for i, _, g in groups if i == g]
    third = corpus_pipeline.stored(stages["decontamination"](spark, second, raw_dir), "t")
    hits = plain_hits([(r["doc_id"], r["text"]) for r in second.collect()], bench)
    assert rows_of(third, "doc_id") == [(r[0],) for r in hits if not r[2]]
    fourth = corpus_pipeline.stored(stages["personal_data"](spark, third, raw_dir), "t")
    assert fourth.columns == docs.columns and rows_of(fourth, "doc_id") == rows_of(third, "doc_id")
    before = dict(rows_of(third, "doc_id", "text"))
    for i, text, n in rows_of(fourth, "doc_id", "text", "n_chars"):
        assert n == len(text)
        for a, _, b, kind in plain_pii(before[i]):
            assert kind in ("card",) or not re.search(re.escape(before[i][a:b]), text)
    last = stages["mixing"](spark, fourth, raw_dir)
    assert {r["doc_id"] for r in last.collect()} <= set(before)


def test_stages_on_odd_rows(spark, raw_dir):
    docs = documents(spark, [*cases(), (70, EN + " write to a.b@c.org", "en", "src1"), (70, None, "en", "src1")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, documents(spark, [])):
            assert stage(spark, rows, raw_dir).columns == docs.columns
    assert corpus_pipeline.mixture(spark, docs, raw_dir).count() > 0


@pytest.mark.parametrize("send", [100, 0])
def test_texts_stay_where_they_are_when_copies_go(spark, raw_dir, monkeypatch, send):
    monkeypatch.setattr(corpus_pipeline.jaccard, "SEND_IDS", send)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = documents(spark, [(3, EN), (1, EN), (2, DE), (2, EN), (None, EN), (None, None), (4, None), (5, ""), (6, DE + " now")])
        kept = corpus_pipeline.one_of_near_copies(spark, docs, raw_dir)
        assert rows_of(kept, "doc_id") == [(1,), (4,), (5,), (None,), (None,)]
        last = kept._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in last and "SortMergeJoin" not in last) == (send > 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
