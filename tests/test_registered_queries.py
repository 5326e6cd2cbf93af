"""Every registered query against its SQL twin on DuckDB, and properties of its plan."""

from __future__ import annotations

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from roadgrain.plans.all_queries import QUERIES
from tests.conftest import SF_DIR

SPARK_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}
# What a fitted tree predicts has no SQL twin.
WITHOUT_SQL = {
    "M3_decision_tree_matrix",
    "M4_random_forest_benchmark",
    "M4_random_forest_classes",
    "A9_grouped_importances",
    "V4_advisories_from_tree",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_queries_and_sql_belong_together():
    assert {name for name, registered in QUERIES.items() if not registered.sql} == WITHOUT_SQL
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 25


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name].run(spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "Window"):
        assert operator not in plan, operator
    assert not re.search(r"LocalLimit|CollectLimit", plan) or name in {
        "Q8_top5_average_congestion_corridors",
        "Q9_top5_high_congestion_percentage_corridors",
        "W3_top_five",
        "S5_output_catalogue",
        "S5_sample_rows",
        "G7_chart_inputs",
    }
    columns = sorted(result.columns)
    rows = sorted(repr(tuple(row[c] for c in columns)) for row in result.collect())
    assert rows
    if name in WITHOUT_SQL:
        return
    cursor = duck.execute(QUERIES[name].sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: SPARK_TYPE.get(str(d[1]), str(d[1])) for d in cursor.description}
    expected = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in cursor.fetchall())
    assert sorted(names) == columns
    assert {f.name: f.dataType.simpleString() for f in result.schema} == kinds
    assert rows == expected
