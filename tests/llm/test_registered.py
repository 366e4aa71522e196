"""Registered queries against their SQL, and the rules that hold for all of them."""

from __future__ import annotations

import inspect

import duckdb
import pytest

import __spark_entry__ as entry_point
from labelstats.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    table = {"op3": "embeddings", "op4": "pages", "op12": "documents"}[name.split("_")[0]]
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = connection.execute(queries.ORACLES[name])
    names = [d[0] for d in expected.description]
    found = queries.QUERIES[name](spark, FOLDER).select(*names).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected.fetchall()))


def test_every_operator_is_registered_once():
    names = [n for n in entry_point.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_point.queries()


def test_native_operators_run_no_python(spark):
    for name in ("op2_shards", "op4_warc"):
        plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_no_local_checkpoint():
    from labelstats.llm import common, components, simhash

    for module in (common, components, simhash):
        assert "localCheckpoint" not in inspect.getsource(module)
