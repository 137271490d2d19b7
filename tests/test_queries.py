"""Checked queries against their SQL on the smallest tables: every other one, and all with QUIRE_ALL_QUERIES=1."""

import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from workload.registry import ORACLES, QUERIES
from workload.verify import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
QUICK = (
    "upsert_publications", "latest_leaf_flag", "run_metrics", "error_summary", "pattern_priority_topk",
    "classify_documents", "best_heading", "ocr_quality", "image_coverage", "sheet_to_grid", "block_index",
    "advance_job_state", "stream_dedup",
)
HALF = sorted({*QUICK, *sorted(QUERIES)[::2]})


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES) if os.environ.get("QUIRE_ALL_QUERIES") else HALF)
def test_query(spark, oracle, name):
    df = queries()[name](spark, FOLDER)
    result = oracle.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())
