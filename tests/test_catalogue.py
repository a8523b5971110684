import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from compare import TABLES, as_rows

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
SOME = ["dq_row_level", "dq_duplicates", "stage_upsert", "scd2_incremental", "gold_fx", "anomaly_pct", "batch_outcomes"]


def test_every_query_of_the_catalogue_has_sql():
    from catalogue.registry import QUERIES

    entry_points.queries()
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@needs_tables
def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@needs_tables
@pytest.mark.parametrize("name", SOME)
def test_query_agrees_with_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = entry_points.queries()[name](spark, FOLDER)
    result = db.execute(entry_points.oracle_sql()[name])
    assert as_rows(df.columns, df.collect()) == as_rows([d[0] for d in result.description], result.fetchall())
