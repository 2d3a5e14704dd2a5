"""The registered queries: each has its SQL, and a sample of cheap ones agrees with it."""

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sitewise.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_flagship(spark):
    rows = entry(spark).collect()
    assert sorted(r.id_categorie for r in rows) == [35, 50]


# All queries are compared by tools/check_sql.py; these are the cheap ones.
@pytest.mark.parametrize(
    "name",
    ["route_by_query", "s1_fragment_lines", "s2_fragment_suppliers", "revenue_by_category_rate", "orders_per_client_named",
     "transition_summary", "compact_changes", "seed_ingest", "audit_placement", "check_primary_key"],
)
def test_agrees_with_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    ours = queries()[name](spark, SF).toPandas()
    theirs = db.execute(oracle_sql()[name]).df()
    columns = sorted(theirs.columns)
    assert sorted(ours.columns) == columns
    left = ours[columns].sort_values(columns, ignore_index=True)
    right = theirs[columns].sort_values(columns, ignore_index=True)
    pd.testing.assert_frame_equal(left, right, check_dtype=False, rtol=0, atol=0)
