from __future__ import annotations

import os
import re

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from point_queries import catalog

DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()
# What fits a model runs Spark's own Python-side algorithms before the plan is made.
MODELS = {"label_index", "rf_predict_counts", "model_round_trip", "holdout_search", "test_score", "cv_search", "sampled_features", "halving_search"}
TABLES = os.environ.get("CHECK_SF_DIR", SF_DIR)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(TABLES):
        connection.execute(f"create view {name.split('.')[0]} as select * from read_parquet('{TABLES}/{name}')")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, v if v is not None else 0) for v in row))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, TABLES)
    columns = sorted(df.columns)
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    assert got
    result = duck.execute(ORACLES[name])
    description = {d[0]: str(d[1]) for d in result.description}
    assert sorted(description) == columns
    assert {c: DUCK_TYPES[t] for c, t in df.dtypes} == description
    position = [list(description).index(c) for c in columns]
    expected = [tuple(row[i] for i in position) for row in result.fetchall()]
    assert ordered(got) == ordered(expected)


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


def test_plans_stay_in_the_jvm(spark):
    for name in sorted(set(ORACLES) - MODELS):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
        for operator in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert operator not in plan, (name, operator)


@pytest.mark.parametrize("name", ["features", "hash_sample", "stratified_hash_sample", "stratified_sample", "fraction_ladder"])
def test_generated_methods_are_small_enough_to_compile(spark, capsys, name):
    """The virtual machine leaves methods above 8000 bytes interpreted, at several times the cost."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        QUERIES[name](spark, SF_DIR).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert 0 < max(sizes) < 8000


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r.Classification for r in rows] == [None, 1, 2, 3, 4, 5, 6, 7, 8]


def test_the_entry_works_without_the_text_operators(monkeypatch):
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    alone = importlib.reload(contract)
    try:
        assert alone.queries() == QUERIES and alone.oracle_sql() == ORACLES
    finally:
        monkeypatch.undo()
        importlib.reload(contract)
