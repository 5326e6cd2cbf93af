"""A third of the rows share one key, nothing may be broadcast, and skewed partitions are split."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from roadgrain.plans.all_queries import QUERIES
from tests.conftest import SF_DIR

NAMES = [
    "Q1_corridor_congestion_summary",
    "Q7_festival_corridor_analysis",
    "A5_class_metrics",
    "A16_corridor_advisory_rollup",
    "J1_calendar_left_join",
    "J2_predictions_join_advisories",
    "J4_corridors_on_route",
    "J5_merged_suggestions",
    "K2_duplicate_keys",
    "K3_surplus_duplicates",
    "K8_raw_file_findings",
    "K10_strict_read_issues",
    "K10_strict_read_good_rows",
    "G5_advisory_checks",
    "P1_standard_projection",
    "P5_corridor_name",
    "R4_route_reasons",
    "R10_one_answer_per_query",
    "S6_stage_sink",
    "S6_stage_date_range",
    "S11_table_fingerprint",
    "S16_date_spine",
]
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
}
HOT_DATE = "timestamp_ntz'1999-11-01 00:00:00'"
CHANGES = {
    "orders": {
        "o_custkey": "if(o_orderkey % 3 = 0, 7L, o_custkey)",
        "o_orderdate": f"if(o_orderkey % 3 = 0, {HOT_DATE}, o_orderdate)",
    },
    "part": {"p_name": "if(p_partkey % 3 = 0, 'hot ring', p_name)", "p_type": "if(p_partkey % 3 = 0, 'PROMO', p_type)"},
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        table = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        for column, expression in CHANGES.get(name, {}).items():
            table = table.withColumn(column, F.expr(expression))
        table.repartition(4).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def duck(skewed):
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{skewed}/{name}.parquet/*.parquet'")
    return connection


@pytest.fixture(scope="module")
def without_broadcast(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SETTINGS:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_change_nothing(spark, skewed, duck, without_broadcast, name):
    result = QUERIES[name].run(spark, skewed)
    columns = sorted(result.columns)
    rows = sorted(repr(tuple(row[c] for c in columns)) for row in result.collect())
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    cursor = duck.execute(QUERIES[name].sql)
    names = [d[0] for d in cursor.description]
    assert rows == sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in cursor.fetchall())


def test_the_hot_customer_is_split(spark, skewed, without_broadcast):
    wide = QUERIES["P1_standard_projection"].run(spark, skewed)
    assert wide.count() == spark.read.parquet(f"{skewed}/orders.parquet").count()
    wide.collect()
    assert "skew=true" in wide._jdf.queryExecution().executedPlan().toString()
