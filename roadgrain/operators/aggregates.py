"""Distributions, key figures and comparisons for a selection of observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadgrain import schemas as S
from roadgrain.functions.derive import adverse_weather, flag_is, is_high, percentage
from roadgrain.operators.rows import unfold
from roadgrain.operators.shape import display_label, scenario_predicate


def dense_counts(data: DataFrame, column: str, domain: list, label: str = "value") -> DataFrame:
    """Count per value of a fixed domain in its order, zero where absent.

    One global aggregate of a handful of counters, so no join with the domain is needed.
    """
    counters = [F.count_if(F.col(column) == F.lit(value)).alias(f"c{i}") for i, value in enumerate(domain)]
    rows = [
        {"position": F.lit(i + 1), label: F.lit(value), "count": F.col(f"c{i}")} for i, value in enumerate(domain)
    ]
    return unfold(data.agg(*counters), rows)


def class_distribution(data: DataFrame, column: str = S.TARGET) -> DataFrame:
    """Rows and percentage per class, dense over Low, Medium, High."""
    counters = [F.count_if(F.col(column) == name).alias(name) for name in S.CLASSES]
    totals = data.agg(F.count(F.lit(1)).alias("total"), *counters)
    return unfold(
        totals,
        [
            {
                "class": F.lit(name),
                "count": F.col(name),
                "percentage": percentage(F.col(name), F.col("total")),
            }
            for name in S.CLASSES
        ],
    )


def distribution(data: DataFrame, column: str) -> DataFrame:
    """Rows per value of any column, ordered by the value."""
    return data.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(column)


def key_figures(data: DataFrame) -> DataFrame:
    """Records, average congestion, High count and share, distinct corridors; null averages when empty."""
    return data.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.avg("congestion_level").alias("average_congestion_level"),
        F.count_if(is_high()).alias("high_congestion_count"),
        percentage(F.count_if(is_high()), F.count(F.lit(1))).alias("high_congestion_percentage"),
        F.count_distinct("corridor").alias("corridor_count"),
    )


_SCENARIO_MEASURES = {
    "average_congestion_level": "congestion_level",
    "average_speed": "average_speed",
    "average_traffic_volume": "traffic_volume",
    "average_travel_time_index": "travel_time_index",
}


def scenario_comparison(data: DataFrame, **controls: str) -> DataFrame:
    """Scenario figures beside those of the whole table, with differences, in one pass.

    Rows (metric, scenario, baseline, delta) plus the record count; ``status`` says
    ``no match`` when no row satisfies the scenario.
    """
    inside = scenario_predicate(**controls)
    high = F.when(is_high(), 100.0).otherwise(0.0)
    measures = {name: F.col(column) for name, column in _SCENARIO_MEASURES.items()}
    measures["high_congestion_percentage"] = high
    aggregates = [
        F.count_if(inside).cast("double").alias("s_record_count"),
        F.count(F.lit(1)).cast("double").alias("b_record_count"),
    ]
    for name, value in measures.items():
        aggregates += [F.avg(F.when(inside, value)).alias(f"s_{name}"), F.avg(value).alias(f"b_{name}")]
    status = F.when(F.col("s_record_count") > 0, "match").otherwise("no match")
    return unfold(
        data.agg(*aggregates),
        [
            {
                "metric": F.lit(name),
                "scenario": F.col(f"s_{name}"),
                "baseline": F.col(f"b_{name}"),
                "delta": F.col(f"s_{name}") - F.col(f"b_{name}"),
                "status": status,
            }
            for name in ("record_count", *measures)
        ],
    )


def compare_groups(data: DataFrame, column: str, labels: dict) -> DataFrame:
    """Mean congestion and High share per label, in label order; a missing label gives nulls."""
    label = display_label(F.col(column), labels)
    names = list(dict.fromkeys(labels.values()))
    aggregates: list[Column] = []
    for i, name in enumerate(names):
        inside = label == name
        aggregates += [
            F.avg(F.when(inside, F.col("congestion_level"))).alias(f"a{i}"),
            F.avg(F.when(inside, F.when(is_high(), 100.0).otherwise(0.0))).alias(f"h{i}"),
        ]
    return unfold(
        data.agg(*aggregates),
        [
            {
                "position": F.lit(i + 1),
                "group": F.lit(name),
                "average_congestion": F.col(f"a{i}"),
                "high_percentage": F.col(f"h{i}"),
            }
            for i, name in enumerate(names)
        ],
    )


def scenario_breakdown(data: DataFrame, **controls: str) -> DataFrame:
    """Mean congestion by weather; by day type once a weather is chosen; else scenario and baseline."""
    chosen = scenario_predicate(**controls)
    column = (
        "weather"
        if controls.get("weather", "All") == "All"
        else "day_type"
        if controls.get("day_type", "All") == "All"
        else None
    )
    if column:
        return (
            data.where(chosen & F.col(column).isNotNull())
            .groupBy(F.col(column).alias("label"))
            .agg(F.avg("congestion_level").alias("average_congestion_level"))
            .orderBy("label")
        )
    pair = data.agg(
        F.avg(F.when(chosen, F.col("congestion_level"))).alias("s"), F.avg("congestion_level").alias("b")
    )
    return unfold(
        pair,
        [
            {"label": F.lit("Selected Scenario"), "average_congestion_level": F.col("s")},
            {"label": F.lit("All Historical Data"), "average_congestion_level": F.col("b")},
        ],
    )


def context_counters() -> dict[str, Column]:
    return {
        "festival": F.count_if(flag_is("festival_flag")),
        "holiday": F.count_if(flag_is("holiday_flag")),
        "roadwork": F.count_if(F.col("roadwork") == "Yes"),
        "rain_or_fog": F.count_if(adverse_weather()),
    }


def context_counts(data: DataFrame) -> DataFrame:
    return data.agg(*[c.alias(name) for name, c in context_counters().items()])


def selection_summary(selected: DataFrame, predicted_advisories: DataFrame) -> DataFrame:
    """Key observations: the selected rows and classes, and the predicted High counts."""
    totals = predicted_advisories.agg(
        F.struct(
            F.count_if(F.col("predicted_congestion_class") == "High").alias("predicted"),
            F.count_if(F.col("advisory_level") == "High").alias("advised"),
        )
    ).scalar()
    return selected.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_distinct("corridor").alias("corridor_count"),
        *[F.count_if(F.col(S.TARGET) == name).alias(f"{name.lower()}_count") for name in S.CLASSES],
    ).select(
        "*",
        totals.getField("predicted").alias("predicted_high_count"),
        totals.getField("advised").alias("high_advisory_count"),
    )
