"""Registered queries and the pipeline on the small table."""

import corpus_pipeline
from mercato.llm import queries, sql

from .util import docs, edge_rows

SF = "/root/testdata/sf0.001"


def test_names_cover_the_operators():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert set(sql.ORACLE) <= set(queries.QUERIES)


def test_pipeline_stages_pass_columns_on(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = d.columns, {r.doc_id for r in d.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        d = corpus_pipeline.cut(stage(spark, d, SF))
        assert d.columns[:len(columns)] == columns
        if k < len(corpus_pipeline.STAGES) - 1:
            assert d.columns == columns
        now = {r.doc_id for r in d.collect()}
        assert now and now <= ids
        ids = now


def test_pipeline_takes_edge_rows_and_empty_tables(spark):
    for rows in (edge_rows(), []):
        d = docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            d = corpus_pipeline.cut(stage(spark, d, SF))
        assert d.count() >= 0
