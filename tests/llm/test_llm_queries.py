"""Registered queries on the smallest tables: SQL twins, contracts, the pipeline."""

import pytest

import corpus_pipeline
from earlybell.llm import decontaminate, secrets
from earlybell.llm.common import store, table
from earlybell.llm.queries import QUERIES
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as components
from tests.llm.test_quality import brute as judged
from tests.oracle import duck, rows_of_duck, rows_of_spark, type_issues

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_matches_sql(spark, name):
    con = duck(SF)
    df = QUERIES[name].build(spark, SF)
    assert rows_of_spark(df) == rows_of_duck(con, QUERIES[name].sql)
    assert type_issues(df, con, QUERIES[name].sql) == []


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql and n not in ("op8_packing", "op12_neighbour_search")])
def test_query_gives_each_document_once(spark, name):
    got = [r.doc_id for r in QUERIES[name].build(spark, SF).select("doc_id").collect()]
    want = [r.doc_id for r in table(spark, SF, "documents").select("doc_id").collect()]
    assert sorted(got) == sorted(want)


def test_entry_registers_all():
    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert {n for n, q in QUERIES.items() if q.sql} <= set(entry.oracle_sql())


def test_pipeline_stages_equal_brute_force(spark):
    from earlybell.llm.quality import Rules

    docs = table(spark, SF, "documents")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        data = sorted([(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()])
        docs = store(stage(spark, docs, SF), name)
        if name == "packing":
            assert {r.doc_id for r in docs.select("doc_id").collect()} == {r[0] for r in data}
            break
        assert docs.columns == columns
        got = {r.doc_id: r.text for r in docs.collect()}
        texts = [r[1] for r in data]
        if name == "quality_rules":
            keep = [kept for _, kept in judged(data, Rules())[1]]
        elif name == "near_copies":
            keep = [k == top for k, (_, top) in enumerate(components(texts))]
        elif name == "decontamination":
            keep = [not hit for _, hit, _ in contaminated(texts, items)]
        else:
            keep = [True] * len(data)
        assert set(got) == {r[0] for r, k in zip(data, keep, strict=True) if k}
        if name == "secrets":
            assert not any(secrets.linked(t.encode()) for t in got.values() if "[SECRET]" in t)
        else:
            assert all(got[r[0]] == r[1] for r in data if r[0] in got)


def test_pipeline_of_an_empty_table(spark):
    docs = table(spark, SF, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_decontamination_keeps_items_apart(spark):
    marked = decontaminate.mark(table(spark, SF, "documents"), table(spark, SF, "benchmark"))
    assert marked.where("n_hit > 0 AND size(hit_items) = 0").count() == 0
