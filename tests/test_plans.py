"""Plans the operators are meant to have."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from roadgrain import schemas as S
from roadgrain.operators import routes as R, summaries
from roadgrain.operators.advisory import advise, corridor_rollup
from roadgrain.operators.calendar import integrate_calendar
from roadgrain.operators.contracts import RAW_FILES, raw_file_findings
from roadgrain.operators.places import match_corridors
from roadgrain.operators.quality import null_counts
from roadgrain.operators.split import chronological_split
from roadgrain.plans.all_queries import QUERIES
from roadgrain.sources.given import calendar, observations


def plan_of(data) -> str:
    return data._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_and_tables_are_read(spark, sf_dir):
    plan = plan_of(observations(spark, sf_dir, "congestion_class"))
    assert "ReadSchema: struct<o_totalprice:double>" in plan and plan.count("FileScan") == 1
    facts = observations(spark, sf_dir, "corridor", "congestion_class", *S.NUMERIC_MEASURES)
    plan = plan_of(summaries.summarise(facts, "top5_average_congestion_corridors"))
    assert "o_orderdate" not in plan and "c_acctbal" not in plan and "TakeOrderedAndProject" in plan


def test_date_bounds_reach_the_scan(spark, sf_dir):
    plan = plan_of(observations(spark, sf_dir, "date", since="1996-01-01", before="1997-01-01"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate,1996-01-01", plan)
    assert re.search(r"LessThan\(o_orderdate,1997-01-01", plan)


def test_small_sides_are_broadcast_without_hints(spark, sf_dir):
    plan = plan_of(observations(spark, sf_dir))
    assert plan.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name, scans", [("J1_calendar_left_join", 2), ("V3_historical_advisories", 2), ("V4_predicted_advisories", 2)])
def test_the_calendar_looks_at_the_facts_once(spark, sf_dir, name, scans):
    assert plan_of(QUERIES[name].run(spark, sf_dir)).count("orders.parquet") <= scans


def test_stored_advisories_are_checked_without_the_facts(spark, sf_dir):
    plan = plan_of(QUERIES["G5_advisory_checks"].run(spark, sf_dir))
    assert "orders.parquet" not in plan and plan.count("FileScan parquet") == 2


@pytest.mark.parametrize(
    "name", ["training_report", "benchmark_report", "advisory_report", "prediction_report", "feature_report"]
)
def test_reports_are_made_of_merged_rows(spark, sf_dir, name):
    """What is left after the one look at the facts reads the stored combinations only."""
    plan = plan_of(QUERIES[f"S8_{name}"].run(spark, sf_dir))
    assert "orders.parquet" not in plan and "customer.parquet" not in plan


def test_keywords_meet_names_on_one_length(spark):
    roads = spark.createDataFrame([(1, "outer ring road")], "request_id int, name string")
    corridors = spark.createDataFrame([(1, "c", ["ring", "outer ring"])], "position int, corridor_id string, keywords array<string>")
    plan = plan_of(match_corridors(roads, corridors))
    assert "Contains(road" in plan and "collect_set" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_large_calendar_is_sorted_instead_of_broadcast(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = integrate_calendar(observations(spark, sf_dir, "obs_id", "date"), calendar(spark, sf_dir))
        assert "SortMergeJoin" in plan_of(joined)
        assert joined.where("festival_flag").count() > 0
        assert joined.count() == observations(spark, sf_dir, "obs_id").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_summaries_aggregate_before_the_shuffle(spark, sf_dir):
    plan = plan_of(summaries.summarise(observations(spark, sf_dir), "corridor_congestion_summary"))
    assert "partial_sum" in plan and plan.index("partial_count") > plan.index("Exchange hashpartitioning(corridor")


def test_all_summaries_read_the_facts_once(spark, sf_dir, tmp_path):
    path = str(tmp_path / "cells")
    results = summaries.summarise_all(observations(spark, sf_dir), path)
    for result in results.values():
        plan = plan_of(result)
        assert "orders.parquet" not in plan and plan.count("FileScan") == 1
    assert spark.read.parquet(path).count() <= 25 * 7 * 4


def test_rollup_of_the_facts_is_hash_based(spark, sf_dir):
    plan = plan_of(corridor_rollup(advise(observations(spark, sf_dir))))
    lowest = plan[plan.rindex("Exchange hashpartitioning(corridor") :]
    assert "HashAggregate(keys=[corridor" in lowest and "SortAggregate(key=[corridor" not in lowest


def test_profile_is_one_aggregate(spark, sf_dir):
    plan = plan_of(null_counts(observations(spark, sf_dir, *[c for c in S.INTEGRATED_COLUMNS if c not in S.CALENDAR_SCHEMA.names or c == "date"])))
    assert plan.count("SinglePartition") == 1


def test_raw_file_checks_share_one_shuffle(spark):
    cells = spark.range(1000).select(
        (F.col("id") % 50).cast("string").alias("timestamp"), F.lit("A").alias("toll_plaza"), F.lit("1").alias("vehicle_count")
    )
    found = raw_file_findings(cells, RAW_FILES["toll.csv"])
    assert {(r.check, r.row_count) for r in found.collect() if r.check != "invalid time"} == {
        ("missing column", None),
        ("duplicate rows", 950),
    }
    assert "ReusedExchange" in plan_of(found)


def test_cutoff_is_a_scalar_subquery(spark, sf_dir):
    training, _, _ = chronological_split(observations(spark, sf_dir, "obs_id", "date"))
    plan = plan_of(training)
    assert "Subquery" in plan and "Join" not in plan


def test_routes_do_not_shuffle(spark):
    stored = spark.createDataFrame([(1, "{}")], "id int, response string")
    answered = R.recommend(R.rank_routes(R.validate_routes(R.parse_responses(stored))))
    assert "Exchange" not in plan_of(answered)
    plan = plan_of(R.ranked_rows(stored, "id"))
    assert plan.count("from_json") == 1 and "Exchange" not in plan


def test_ranks_alone_need_no_texts(spark):
    rows = R.ranked_rows(spark.createDataFrame([(1, "{}")], "id int, response string"), "id")
    assert "format_string" in plan_of(rows)
    assert "format_string" not in plan_of(rows.select("id", "rank", "route_index"))


def test_skewed_corridor_is_merged_before_the_shuffle(spark):
    """One corridor holds nearly all rows; each task still sends one row per corridor."""
    skewed = spark.range(0, 100000, 1, 8).select(
        F.when(F.col("id") % 100 == 0, "rare").otherwise("hot").alias("corridor"),
        *[(F.col("id") % 7).cast("double").alias(name) for name in S.NUMERIC_MEASURES],
        F.lit("High").alias("congestion_class"),
    )
    got = summaries.summarise(skewed, "high_congestion_corridors").collect()
    assert {(r.corridor, r.total_records) for r in got} == {("hot", 99000), ("rare", 1000)}


def test_corridor_matching_shares_one_shuffle(spark):
    roads = spark.range(1000).select((F.col("id") % 100).alias("request_id"), F.concat(F.lit("road "), "id").alias("name"))
    table = spark.createDataFrame([(1, "one", ["road 7"])], "position int, corridor_id string, keywords array<string>")
    found = match_corridors(roads, table)
    rows = found.collect()
    assert len(rows) == 100
    hits = {i % 100 for i in range(1000) if f"road {i}".find("road 7") >= 0}
    assert {r.request_id for r in rows if not r.is_fallback} == hits
    assert "ReusedExchange" in plan_of(found)
