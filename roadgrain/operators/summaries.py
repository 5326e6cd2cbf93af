"""The nine named congestion summaries.

A summary is a group-by whose results are sums and counts followed by a projection.
Sums and counts can be merged, so all nine can come from one pass over the facts:
``summary_cells`` groups by every dimension at once and the summaries re-aggregate
its few thousand rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from roadgrain import schemas as S
from roadgrain.functions.derive import percentage
from roadgrain.session import fresh_path
from roadgrain.sources.files import write_stage

DIMENSIONS = ["corridor", "day_type", "day_of_week", "festival_flag", "holiday_flag"]


@dataclass(frozen=True)
class Summary:
    """What one summary groups by, selects, orders by and keeps."""

    key: str
    columns: dict[str, str]
    order: tuple[tuple[str, bool], ...]
    only: str | None = None
    limit: int | None = None
    ties: str = field(default="corridor")


def _averages(*names: str) -> dict[str, str]:
    return {f"average_{name.removeprefix('average_')}": f"avg:{name}" for name in names}


_FOUR = ("traffic_volume", "average_speed", "congestion_level", "travel_time_index")
_HIGH = {"high_congestion_count": "high", "high_congestion_percentage": "high%"}
_BY_PERCENTAGE = (("high_congestion_percentage", False),)
_BY_AVERAGE = (("average_congestion_level", False),)

SUMMARIES: dict[str, Summary] = {
    "corridor_congestion_summary": Summary(
        "corridor",
        {
            "record_count": "rows",
            **_averages(*_FOUR),
            "low_congestion_count": "low",
            "medium_congestion_count": "medium",
            "high_congestion_count": "high",
        },
        _BY_AVERAGE,
    ),
    "high_congestion_corridors": Summary("corridor", {"total_records": "rows", **_HIGH}, _BY_PERCENTAGE),
    "day_type_congestion_summary": Summary(
        "day_type", {"record_count": "rows", **_averages(*_FOUR), **_HIGH}, (("day_type", True),)
    ),
    "festival_congestion_summary": Summary(
        "festival_flag", {"record_count": "rows", **_averages(*_FOUR), **_HIGH}, (("festival_flag", True),)
    ),
    "holiday_congestion_summary": Summary(
        "holiday_flag", {"record_count": "rows", **_averages(*_FOUR[:3]), **_HIGH}, (("holiday_flag", True),)
    ),
    "day_of_week_congestion_summary": Summary(
        "day_of_week",
        {"record_count": "rows", **_averages(*_FOUR[:3]), "high_congestion_percentage": "high%"},
        (("day_of_week", True),),
    ),
    "festival_corridor_analysis": Summary(
        "corridor",
        {
            "festival_record_count": "rows",
            "average_festival_traffic_volume": "avg:traffic_volume",
            "average_festival_congestion_level": "avg:congestion_level",
            **_HIGH,
        },
        (("average_festival_congestion_level", False),),
        only="festival_flag",
    ),
    "top5_average_congestion_corridors": Summary(
        "corridor",
        {"record_count": "rows", "average_congestion_level": "avg:congestion_level"},
        _BY_AVERAGE,
        limit=5,
    ),
    "top5_high_congestion_percentage_corridors": Summary(
        "corridor", {"total_records": "rows", **_HIGH}, _BY_PERCENTAGE, limit=5
    ),
}


def _partials() -> dict[str, Column]:
    counts = {f"n_{name.lower()}": F.count_if(F.col(S.TARGET) == name) for name in S.CLASSES}
    sums = {f"sum_{name}": F.sum(name) for name in S.NUMERIC_MEASURES}
    present = {f"n_{name}": F.count(name) for name in S.NUMERIC_MEASURES}
    return {"n_rows": F.count(F.lit(1)), **counts, **sums, **present}


def summary_cells(facts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Mergeable counts and sums per combination of the dimensions."""
    return facts.groupBy(*(keys or DIMENSIONS)).agg(*[c.alias(name) for name, c in _partials().items()])


def _merged(cells: DataFrame, keys: list[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in _partials()])


def _output(kind: str) -> Column:
    if kind.startswith("avg:"):
        name = kind[4:]
        return F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}").cast("double"))
    if kind == "high%":
        return percentage(F.col("n_high"), F.col("n_rows"))
    return F.col(f"n_{kind}")


def _present(cells: DataFrame, summary: Summary) -> DataFrame:
    result = cells.select(summary.key, *[_output(kind).alias(name) for name, kind in summary.columns.items()])
    order = [F.col(name).asc() if ascending else F.col(name).desc() for name, ascending in summary.order]
    if summary.key not in {name for name, _ in summary.order}:
        order.append(F.col(summary.key).asc())
    result = result.orderBy(*order)
    return result.limit(summary.limit) if summary.limit else result


def summarise(facts: DataFrame, name: str) -> DataFrame:
    """One named summary, straight from the facts; only the columns it uses are read."""
    summary = SUMMARIES[name]
    if summary.only:
        facts = facts.where(F.col(summary.only))
    return _present(summary_cells(facts, [summary.key]), summary)


def summarise_all(facts: DataFrame, path: str | None = None) -> dict[str, DataFrame]:
    """All nine summaries from a single pass over the facts.

    The pass runs here: its cells, a few thousand rows, are written to ``path`` (a new
    folder in the shared folder by default) and read back, so that a lost executor never
    makes a summary read the facts again.
    """
    spark = facts.sparkSession
    cells = summary_cells(facts)
    stored = write_stage(cells, path or fresh_path(spark, "cells"), cells.columns)
    cells = spark.read.schema(cells.schema).parquet(stored)
    results = {}
    for name, summary in SUMMARIES.items():
        chosen = cells.where(F.col(summary.only)) if summary.only else cells
        results[name] = _present(_merged(chosen, [summary.key]), summary)
    return results


def register_view(facts: DataFrame, name: str = "traffic_data") -> None:
    """Make the facts available to ``spark.sql`` text."""
    facts.createOrReplaceTempView(name)
