"""Every registered query over the smallest tables, against SQL where there is some."""

import duckdb
import pytest

import corpus_pipeline
from clickmill.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_there():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    base = duckdb.connect()
    for table in ("pages", "documents"):
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = base.sql(ORACLES[name])
    found = QUERIES[name](spark, SF)
    names = sorted(expected.columns)
    assert names == sorted(found.columns)
    key = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    assert key(found.select(*names).collect()) == key(expected.select(*names).fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert 4 <= len(stages) <= 5
    columns, count = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == columns, name
        rows = kept.collect()
        assert 0 < len(rows) <= count
        docs, count = spark.createDataFrame(rows, docs.schema), len(rows)
    final = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in final} == {r["doc_id"] for r in docs.collect()}
    assert sum(r["taken"] for r in final) > 0
