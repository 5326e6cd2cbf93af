from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roadgrain import schemas as S
from roadgrain.models import trees as T
from roadgrain.operators import aggregates as A, scoring, summaries
from roadgrain.plans.registry import rounded
from roadgrain.sources.given import observations
from tests.conftest import values

# Published counts (actual, predicted) of two models on one test period.
TREE = [("High", "High", 900), ("High", "Medium", 46), ("Low", "Low", 359), ("Low", "Medium", 31)]
TREE += [("Medium", "High", 44), ("Medium", "Low", 24), ("Medium", "Medium", 387)]
FOREST = [("High", "High", 939), ("High", "Medium", 7), ("Low", "Low", 359), ("Low", "Medium", 31)]
FOREST += [("Medium", "High", 110), ("Medium", "Low", 25), ("Medium", "Medium", 320)]
MATRIX = "actual_class string, predicted_class string, count bigint"


def test_published_tree_metrics(spark):
    matrix = spark.createDataFrame(TREE, MATRIX)
    weighted = {m: round(v, 6) for m, v in values(scoring.weighted_metrics(matrix))}
    assert weighted == {
        "Accuracy": 0.919040,
        "Weighted Precision": 0.919577,
        "Weighted Recall": 0.919040,
        "F1 Score": 0.919270,
    }
    got = [(c, round(p, 6), round(r, 6), round(f, 6), s) for _, c, p, r, f, s in values(scoring.class_metrics(matrix))]
    assert got == [
        ("High", 0.953390, 0.951374, 0.952381, 946),
        ("Low", 0.937337, 0.920513, 0.928849, 390),
        ("Medium", 0.834052, 0.850549, 0.842220, 455),
    ]


def test_published_forest_metrics(spark):
    matrix = spark.createDataFrame(FOREST, MATRIX)
    weighted = {m: round(v, 6) for m, v in values(scoring.weighted_metrics(matrix))}
    assert weighted == {
        "Accuracy": 0.903406,
        "Weighted Precision": 0.903470,
        "Weighted Recall": 0.903406,
        "F1 Score": 0.899209,
    }
    assert [round(r[0], 6) for r in values(scoring.class_metrics(matrix), "f1")] == [0.941353, 0.927649, 0.787208]


def test_class_never_predicted_gives_zero(spark):
    matrix = spark.createDataFrame([("High", "Low", 3), ("Low", "Low", 5)], MATRIX)
    got = {c: (p, r, f, s) for _, c, p, r, f, s in values(scoring.class_metrics(matrix))}
    assert got["High"] == (0.0, 0.0, 0.0, 3)
    assert got["Medium"] == (0.0, 0.0, 0.0, 0)
    empty = spark.createDataFrame([], MATRIX)
    assert [v for _, v in values(scoring.weighted_metrics(empty))] == [0.0] * 4
    assert values(scoring.dense_matrix(empty), *S.CLASSES) == [(0, 0, 0)] * 3


def test_matrix_matches_evaluators(spark):
    labels = S.CLASSES_ALPHABETIC
    scored = spark.createDataFrame(
        [(float(labels.index(a)), float(labels.index(p))) for a, p, n in TREE for _ in range(n // 10 + 1)],
        "label double, prediction double",
    )
    decoded = T.decode(scored, labels)
    matrix = scoring.confusion_matrix(decoded)
    assert matrix.agg(F.sum("count")).first()[0] == scored.count()
    ours = dict(values(scoring.weighted_metrics(matrix)))
    for name, value in T.evaluator_metrics(scored).items():
        assert ours[name] == pytest.approx(value, abs=1e-12)


def test_model_comparisons(spark):
    tree, forest = (spark.createDataFrame(m, MATRIX) for m in (TREE, FOREST))
    table = scoring.compare_models({"t": scoring.weighted_metrics(tree), "f": scoring.weighted_metrics(forest)})
    assert table.columns == ["metric", "t", "f"] and table.count() == 4
    classes = scoring.compare_classes({"t": scoring.class_metrics(tree), "f": scoring.class_metrics(forest)})
    assert values(classes, "class", "model") == [(c, m) for c in S.CLASSES_ALPHABETIC for m in ("t", "f")]


FACTS = (
    "corridor string, day_type string, day_of_week int, festival_flag boolean, holiday_flag boolean, traffic_volume double, "
    "average_speed double, travel_time_index double, congestion_level double, congestion_class string"
)


@pytest.fixture
def facts(rows):
    return rows(
        FACTS,
        ("a", "Weekday", 2, False, False, 10.0, 30.0, 1.0, 50.0, "Low"),
        ("a", "Weekend", 1, True, True, 20.0, None, 1.2, 95.0, "High"),
        ("b", "Weekday", 2, False, True, 30.0, 40.0, 1.4, 95.0, "High"),
        ("c", "Weekday", 3, False, False, 30.0, 40.0, 1.4, 95.0, "High"),
        ("c", "Weekday", 3, False, False, 30.0, 40.0, 1.4, None, None),
    )


def test_corridor_summary(facts):
    got = values(rounded(summaries.summarise(facts, "corridor_congestion_summary")))
    assert got == [
        ("b", 1, 30.0, 40.0, 95.0, 1.4, 0, 0, 1),
        ("c", 2, 30.0, 40.0, 95.0, 1.4, 0, 0, 1),
        ("a", 2, 15.0, 30.0, 72.5, 1.1, 1, 0, 1),
    ]


def test_percentages_ties_and_festival_rows(facts):
    assert values(summaries.summarise(facts, "high_congestion_corridors")) == [
        ("b", 1, 1, 100.0),
        ("a", 2, 1, 50.0),
        ("c", 2, 1, 50.0),
    ]
    assert values(summaries.summarise(facts, "festival_corridor_analysis")) == [("a", 1, 20.0, 95.0, 1, 100.0)]
    flags = values(summaries.summarise(facts, "festival_congestion_summary"), "festival_flag", "record_count")
    assert flags == [(False, 4), (True, 1)]


def test_shared_cells_give_the_same_summaries(facts):
    together = summaries.summarise_all(facts)
    for name in summaries.SUMMARIES:
        assert values(rounded(together[name])) == values(rounded(summaries.summarise(facts, name))), name


def test_result_does_not_depend_on_partitions(spark, sf_dir):
    data = observations(spark, sf_dir)
    for name in ("corridor_congestion_summary", "festival_corridor_analysis"):
        one, many = (values(rounded(summaries.summarise(data.repartition(n), name))) for n in (1, 16))
        assert one == many
    classes = summaries.summarise(data, "corridor_congestion_summary").where(
        "low_congestion_count + medium_congestion_count + high_congestion_count <> record_count"
    )
    assert classes.count() == 0


def test_distributions(facts):
    assert values(A.class_distribution(facts)) == [("Low", 1, 20.0), ("Medium", 0, 0.0), ("High", 3, 60.0)]
    assert values(A.class_distribution(facts.limit(0)), "percentage") == [(None,)] * 3
    assert values(A.distribution(facts, "corridor")) == [("a", 2), ("b", 1), ("c", 2)]
    assert values(A.dense_counts(facts, "corridor", ["c", "z"]), "value", "count") == [("c", 2), ("z", 0)]


def test_key_figures_of_nothing(facts):
    assert values(A.key_figures(facts.limit(0))) == [(0, None, 0, None, 0)]


def test_scenario_comparison(facts):
    wide = facts.withColumns({"weather": F.lit("Fog"), "roadwork": F.lit("No")})
    got = {m: (s, b, d, status) for m, s, b, d, status in values(A.scenario_comparison(wide, corridor="a"))}
    assert got["record_count"] == (2.0, 5.0, -3.0, "match")
    assert got["high_congestion_percentage"] == (50.0, 60.0, -10.0, "match")
    nothing = values(A.scenario_comparison(wide, weather="Rain"), "scenario", "status")
    assert nothing == [(0.0, "no match")] + [(None, "no match")] * 5


def test_group_comparison_keeps_label_order(facts):
    labels = {True: "Festival", False: "Non-Festival"}
    assert values(A.compare_groups(facts, "festival_flag", labels), "group") == [("Festival",), ("Non-Festival",)]
    absent = A.compare_groups(facts.where("NOT festival_flag"), "festival_flag", labels)
    assert values(absent)[0] == (1, "Festival", None, None)


def test_selection_summary(facts, rows):
    advised = rows("predicted_congestion_class string, advisory_level string", ("High", "High"), ("Low", "Normal"))
    assert values(A.selection_summary(facts, advised)) == [(5, 3, 1, 0, 3, 1, 1)]
