"""Renames, typing, filters and lookups."""

from __future__ import annotations

from collections.abc import Iterable

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from roadgrain import schemas as S
from roadgrain.functions.derive import corridor_name, day_type, in_range, is_finite, parse_date, threshold_class
from roadgrain.functions.text import strip

ALL = "All"


def standardise(
    raw: DataFrame, low_below: float = S.LOW_BELOW, medium_below: float = S.MEDIUM_BELOW, keep: Iterable[str] = ()
) -> DataFrame:
    """Raw columns to the standard ones with the derived class and calendar fields.

    One projection; the raw columns without a standard name are not read. ``keep``
    names extra columns to carry in front.
    """
    source = {standard: F.col(f"`{raw_name}`") for raw_name, standard in S.RAW_TO_STANDARD.items()}
    weekday = F.dayofweek(source["date"])
    derived = {
        "congestion_class": threshold_class(source["congestion_level"], low_below, medium_below),
        "day_of_week": weekday,
        "day_type": day_type(weekday),
    }
    return raw.select(
        *keep, *[(source.get(name, derived.get(name))).alias(name) for name in S.STANDARD_SCHEMA.names]
    )


def add_corridor(data: DataFrame) -> DataFrame:
    return data.withColumn("corridor", corridor_name(F.col("area"), F.col("road_intersection")))


def typed(data: DataFrame, schema: StructType) -> DataFrame:
    """Cast the columns named in the schema in one projection; bad cells become null."""
    wanted = {field.name: field.dataType for field in schema.fields}

    def cast(name: str) -> Column:
        if name not in wanted:
            return F.col(name)
        kind = wanted[name]
        if kind.typeName() == "date" and dict(data.dtypes)[name] == "string":
            return parse_date(name).alias(name)
        return F.col(name).try_cast(kind).alias(name)

    return data.select(*[cast(name) for name in data.columns])


def filtered(
    data: DataFrame,
    date_range: tuple[str, str] | None = None,
    corridors: list[str] | None = None,
    classes: list[str] | None = None,
    day_types: list[str] | None = None,
    festival_flag: str = ALL,
    holiday_flag: str = ALL,
) -> DataFrame:
    """All the page filters together, as one predicate.

    ``None`` leaves a list filter out, an empty list selects nothing. The class filter
    applies to ``actual_congestion_class`` when there is no ``congestion_class``; a
    filter on a column the table lacks is skipped.
    """
    predicates: list[Column] = []
    if date_range is not None and "date" in data.columns:
        first, last = (F.lit(bound).cast("date") for bound in date_range)
        predicates.append(F.col("date").between(first, last))
    class_column = S.TARGET if S.TARGET in data.columns else "actual_congestion_class"
    for column, allowed in (("corridor", corridors), (class_column, classes), ("day_type", day_types)):
        if allowed is not None and column in data.columns:
            predicates.append(F.col(column).isin(allowed) if allowed else F.lit(False))
    for column, choice in (("festival_flag", festival_flag), ("holiday_flag", holiday_flag)):
        if choice != ALL and column in data.columns:
            predicates.append(F.col(column) == F.lit(choice == "True"))
    for predicate in predicates:
        data = data.where(predicate)
    return data


# The controls of a scenario, the column each reads, its choice that leaves everything in,
# and the choice that stands for a true flag.
SCENARIO_CONTROLS = {
    "corridor": ("corridor", "All Corridors", None),
    "day_type": ("day_type", ALL, None),
    "festival": ("festival_flag", ALL, "Festival"),
    "holiday": ("holiday_flag", ALL, "Holiday"),
    "weather": ("weather", ALL, None),
    "roadwork": ("roadwork", ALL, None),
}


def scenario_predicate(**choices: str) -> Column:
    """Predicate of the scenario controls that are set; one that is left out or set to "all" keeps every row."""
    unknown = choices.keys() - SCENARIO_CONTROLS.keys()
    if unknown:
        raise ValueError(f"No such scenario control: {', '.join(sorted(unknown))}.")
    wanted = {name: choice for name, choice in choices.items() if choice != SCENARIO_CONTROLS[name][1]}
    terms = [F.lit(True)]
    for name, choice in wanted.items():
        column, _, when_true = SCENARIO_CONTROLS[name]
        terms.append(F.col(column) == (F.lit(choice) if when_true is None else F.lit(choice == when_true)))
    return reduce(Column.__and__, terms)


def filter_scenario(data: DataFrame, **controls: str) -> DataFrame:
    return data.where(scenario_predicate(**controls))


def lookup(data: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose key equals the value exactly; empty when there are none."""
    return data.where(F.col(key) == F.lit(value))


def display_label(column: Column, labels: dict) -> Column:
    """Recode a flag or category; values without a label become null."""
    result = F.lit(None).cast("string")
    for value, label in labels.items():
        result = F.when(column == F.lit(value), label).otherwise(result)
    return result


def endpoint_problem(
    origin: Column, destination: Column, origin_point: tuple[Column, Column], destination_point: tuple[Column, Column]
) -> Column:
    """Why a pair of end points cannot be routed, null when it can.

    Empty text first, then equal text in any case, then equal coordinates.
    """
    start, end = (F.coalesce(strip(text), F.lit("")) for text in (origin, destination))
    same_point = (origin_point[0] == destination_point[0]) & (origin_point[1] == destination_point[1])
    return (
        F.when(start == "", "EMPTY_ORIGIN")
        .when(end == "", "EMPTY_DESTINATION")
        .when(F.lower(start) == F.lower(end), "SAME_PLACE")
        .when(F.coalesce(same_point, F.lit(False)), "SAME_PLACE")
    )


def coordinate_problem(latitude: Column, longitude: Column) -> Column:
    """INCOMPLETE, NOT_FINITE or OUT_OF_RANGE; null for a good or an absent pair."""
    return (
        F.when(latitude.isNull() & longitude.isNull(), F.lit(None))
        .when(latitude.isNull() | longitude.isNull(), "INCOMPLETE")
        .when(~(is_finite(latitude) & is_finite(longitude)), "NOT_FINITE")
        .when(~(in_range(latitude, -90, 90) & in_range(longitude, -180, 180)), "OUT_OF_RANGE")
    )
