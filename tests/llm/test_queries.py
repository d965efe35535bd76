"""The registered queries on the smallest tables: they run whole, and those with SQL equal it."""

from __future__ import annotations

import glob
import os
from collections import Counter

import corpus_pipeline
import duckdb
import pytest

from telemetry_lake.llm.queries import ORACLES, QUERIES

TABLE = {"op11": None, "op13": None, "op2": None, "op3": "documents", "op7": "pages", "op8": None, "op9": "pages"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in found.collect()]
    table = TABLE.get(name.split("_")[0], "documents")
    if table and not name.startswith("op1_"):
        assert len(rows) == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    assert rows
    if name in ORACLES:
        con = duckdb.connect()
        for path in glob.glob(f"{sf_dir}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
        cursor = con.execute(ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert Counter(tuple(r[i] for i in map(names.index, found.columns)) for r in cursor.fetchall()) == Counter(rows)


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    assert corpus_pipeline.ORACLE_SQL is None
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        left = {r[0] for r in docs.select("doc_id").collect()}
        assert left < ids or left == ids
        ids = left
    packed = {r[0] for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).select("doc_id").collect()}
    assert packed == ids == {r[0] for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect()}


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Null ids and texts, repeated rows, columns with clashing names; then empty tables."""
    text = " ".join(f"word{i} other{i * 7 % 13}" for i in range(40))
    rows = [(None, text, "en", 1), (None, text, "en", 1), (None, None, None, None), (3, text + " more", "en", 2)]
    rows += [(4, "", "", 0), (4, "", "", 0), (5, "own words of this one", "de", 3), (6, "benchmark " * 3 + text[::-1], "x", 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _key string, piece int")
    labels = spark.createDataFrame([(3, 1, 0), (5, 0, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([(1, text[::-1]), (None, None), (2, "")], "item_id bigint, text string")
    for name, keep in (("whole", True), ("empty", False)):
        for table, df in (("documents", docs), ("labels", labels), ("benchmark", items)):
            (df if keep else df.limit(0)).write.parquet(f"{tmp_path}/{name}/{table}.parquet")
    packed = corpus_pipeline.run(spark, f"{tmp_path}/whole").collect()
    # One of the copies stays, with the least id (null is none), the empty texts are one, 6 holds an item.
    assert sorted((r.doc_id for r in packed), key=str) == [3, 4, 5]
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
