"""The pipeline stage by stage, and the registered queries against their SQL."""

import random
import re

import corpus_pipeline
import duckdb
import pyarrow as pa
import pytest
from cases import SCHEMA, awkward_rows, empty, sentence
from pyspark.sql import functions as F
from workload.verify import TABLES, rows_of

from __spark_entry__ import oracle_sql, queries
from quire.llm.common import ROWS_AT_ONCE
from quire.llm.registry import ORACLES, QUERIES
from quire.session import new_shared_path

FOLDER = "/root/testdata/sf0.001"


def corpus_rows():
    rng = random.Random(6)
    rows = [(3000 + i, " ".join(sentence(rng, ("en", "fr", "de")[i % 3]) for _ in range(3)), ("en", "fr", "de")[i % 3], "abc"[i % 3], 1) for i in range(120)]
    rows += [(4000 + i, rows[i][1], rows[i][2], rows[i][3], 1) for i in range(30)]
    rows.append((5000, rows[50][1] + " password=abcdefgh12 " + sentence(rng, "de"), "de", "a", 1))
    return rows + awkward_rows()


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "secret scans", "mixing sources to target weights",
        "SentencePiece encoding and decoding"]
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert "pipeline" in queries() and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("stage", ["identify", "deduplicate", "encode"])
def test_stages_hand_texts_to_python_in_small_batches(spark, stage):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.createDataFrame(corpus_rows()[:30], SCHEMA)
    before = spark.conf.get(key)
    try:
        for given, kept in ((10_000, ROWS_AT_ONCE), (0, ROWS_AT_ONCE), (7, 7)):
            spark.conf.set(key, str(given))
            if stage == "deduplicate" and given != 10_000:
                continue
            getattr(corpus_pipeline, stage)(spark, docs, "")
            assert int(spark.conf.get(key)) == kept
            sizes = spark.range(3000, numPartitions=1).mapInArrow(
                lambda batches: (b.select([0]).slice(0, 1).set_column(0, "id", pa.array([b.num_rows])) for b in batches), "id long")
            assert max(r["id"] for r in sizes.collect()) <= kept
    finally:
        spark.conf.set(key, before)


def test_each_stage_takes_effect(spark):
    docs = spark.createDataFrame(corpus_rows(), SCHEMA).withColumn("row", F.lit(1))
    steps, kept = dict(corpus_pipeline.STAGES), {}
    for name, stage in list(corpus_pipeline.STAGES)[:-1]:
        docs_next = stage(spark, docs, "")
        assert docs_next.columns == docs.columns
        path = new_shared_path(spark, "stage")
        docs_next.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs.collect()
    ids = [{r.doc_id for r in rows} for rows in kept.values()]
    assert {3000 + i for i in range(120)} <= ids[0] and not ids[0] & {1, 2, 3, 8}
    assert {3000 + i for i in range(120)} <= ids[1] and not ids[1] & set(range(4000, 4030))
    assert len(kept["n-gram Jaccard join"]) == len(kept["secret scans"])
    assert not any(re.search("password=abc", r.text) for r in kept["secret scans"])
    assert ids[3] <= ids[2] and len(kept["mixing sources to target weights"]) > 0
    last = steps["SentencePiece encoding and decoding"](spark, docs, "").collect()
    assert len(last) == len(kept["mixing sources to target weights"]) and all(len(r.ids) > 2 for r in last)


def test_stages_take_an_empty_table(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), "").count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = QUERIES[name](spark, FOLDER)
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(found.columns)
    assert rows_of(found.columns, found.collect()) == rows_of(columns, result.fetchall())
