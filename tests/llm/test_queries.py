"""The registered queries: SQL where there is any, and the pipeline stage by stage."""

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in queries() if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in queries()


@pytest.mark.parametrize("name", ["op3_warc", "op4_chat", "op5_quality", "op11_fim", "op13_lines"])
def test_agrees_with_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    ours, theirs = queries()[name](spark, SF).toPandas(), db.execute(oracle_sql()[name]).df()
    columns = sorted(theirs.columns)
    left, right = (x[columns].sort_values(columns, ignore_index=True) for x in (ours, theirs))
    pd.testing.assert_frame_equal(left, right, check_dtype=False)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    rows = docs.collect()
    assert 0 < len(rows) < len(before) and len({r.text for r in rows}) == len(rows)
    assert all(r.n_chars == len(r.text) for r in rows)
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in rows}
