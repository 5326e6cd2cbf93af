from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from roadgrain import schemas as S
from roadgrain.operators import shape
from roadgrain.operators.calendar import day_category, integrate_calendar, neighbour_holidays
from roadgrain.operators.split import chronological_split, cutoff_date, split_at
from tests.conftest import values


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


CALENDAR = "date date, festival_name string, festival_flag boolean, holiday_flag boolean"


def test_calendar_join_keeps_every_row(rows):
    facts = rows("id int, date date", (1, day(0)), (2, day(0)), (3, day(1)), (4, None))
    calendar = rows(CALENDAR, (day(0), "Feast", True, True), (day(9), "Other", True, False))
    got = values(integrate_calendar(facts, calendar).orderBy("id"))
    assert got == [
        (1, day(0), True, "Feast", True),
        (2, day(0), True, "Feast", True),
        (3, day(1), False, None, False),
        (4, None, False, None, False),
    ]


@pytest.mark.parametrize("twice", [day(0), None])
def test_duplicate_calendar_dates_fail(rows, twice):
    facts = rows("id int, date date", (1, day(0)))
    calendar = rows(CALENDAR, (twice, "A", True, True), (twice, "B", True, True))
    with pytest.raises(PySparkException, match="duplicate date keys"):
        integrate_calendar(facts, calendar).collect()


def test_day_categories(rows):
    friday = dt.date(2024, 1, 5)
    days = rows(
        "date date, is_festival boolean", (friday, False), (day(9), True), (day(8), False), (day(10), False), (day(2), False)
    )
    got = dict(values(day_category(neighbour_holidays(days, rows("date date", (day(9),)))), "date", "day_type"))
    assert got == {
        friday: "Friday Evening",
        day(9): "Festival Day",
        day(8): "Pre-Holiday",
        day(10): "Post-Holiday",
        day(2): "Normal Day",
    }


@pytest.mark.parametrize("n, training", [(2, 1), (3, 2), (5, 4), (10, 8), (35, 28), (7, 5)])
def test_cutoff_counts_distinct_dates(spark, n, training):
    data = spark.createDataFrame([(day(i % n), i) for i in range(3 * n)], "date date, id int")
    assert values(cutoff_date(data)) == [(day(training - 1), n, training)]
    before, after, _ = chronological_split(data)
    assert before.count() + after.count() == 3 * n
    assert before.agg(F.max("date")).first()[0] < after.agg(F.min("date")).first()[0]


def test_one_date_cannot_be_split(rows):
    with pytest.raises(PySparkException, match="At least two distinct dates"):
        cutoff_date(rows("date date", (day(0),), (day(0),))).collect()


def test_split_at_given_date(rows):
    before, after = split_at(rows("date date", (day(0),), (day(1),), (day(2),)), day(1).isoformat())
    assert (before.count(), after.count()) == (2, 1)


def test_standardise_keeps_nulls(spark):
    raw = spark.createDataFrame(
        [
            (dt.date(2024, 1, 6), "A", "R", 1.0, 2.0, 3.0, None, *[0.0] * 7, "Rain", "No"),
            (None, None, "R", 1.0, 2.0, 3.0, 95.0, *[0.0] * 7, None, "Yes"),
        ],
        S.RAW_SCHEMA,
    )
    result = shape.add_corridor(shape.standardise(raw))
    assert result.columns == S.TAGGED_SCHEMA.names
    assert [f.dataType for f in result.schema] == [f.dataType for f in S.TAGGED_SCHEMA]
    assert values(result, "congestion_class", "day_of_week", "day_type", "corridor") == [
        (None, 7, "Weekend", "A | R"),
        ("High", None, None, None),
    ]


FACTS = "id int, date date, corridor string, congestion_class string, day_type string, festival_flag boolean, holiday_flag boolean"


@pytest.fixture
def facts(rows):
    return rows(
        FACTS,
        (1, day(0), "a", "Low", "Weekday", False, False),
        (2, day(1), "b", "High", "Weekend", True, True),
        (3, day(2), "a", "High", "Weekday", False, True),
        (4, None, "a", "High", "Weekday", False, True),
        (5, day(2), None, None, None, None, None),
    )


@pytest.mark.parametrize(
    "filters, ids",
    [
        ({}, [1, 2, 3, 4, 5]),
        ({"date_range": ("2024-01-02", "2024-01-03")}, [2, 3, 5]),
        ({"corridors": ["a"], "classes": ["High"]}, [3, 4]),
        ({"corridors": []}, []),
        ({"day_types": ["Weekend"], "festival_flag": "True"}, [2]),
        ({"holiday_flag": "False"}, [1]),
    ],
)
def test_page_filters(facts, filters, ids):
    assert sorted(r[0] for r in values(shape.filtered(facts, **filters), "id")) == ids


def test_page_filter_uses_actual_class_and_skips_absent_columns(facts):
    predictions = facts.withColumnRenamed("congestion_class", "actual_congestion_class").drop("day_type")
    got = shape.filtered(predictions, classes=["High"], day_types=[])
    assert sorted(r[0] for r in values(got, "id")) == [2, 3, 4]


def test_scenario_filter_without_match(facts):
    wide = facts.withColumns({"weather": F.lit("Fog"), "roadwork": F.lit("No")})
    assert shape.filter_scenario(wide, weather="Rain").count() == 0
    with pytest.raises(ValueError, match="No such scenario control: hour"):
        shape.filter_scenario(wide, hour="8")
    assert sorted(r[0] for r in values(shape.filter_scenario(wide, holiday="Holiday", festival="Non-Festival"), "id")) == [3, 4]
    assert shape.lookup(facts, "corridor", "nowhere").count() == 0


def test_bad_cells_become_null(rows):
    cells = rows("date string, traffic_volume string, festival_flag string", ("2024-02-30", "x", "maybe"), ("2024-02-29", "1.5", "TRUE"))
    assert values(shape.typed(cells, S.INTEGRATED_SCHEMA)) == [(None, None, None), (dt.date(2024, 2, 29), 1.5, True)]


def test_endpoints_and_coordinates(rows):
    nan = float("nan")
    data = rows(
        "a string, b string, x double, y double",
        (" ", "b", 1.0, 2.0),
        ("a", None, 1.0, 2.0),
        ("Hebbal ", "hebbal", 1.0, 2.0),
        ("a", "b", 1.0, 2.0),
        ("a", "b", None, 2.0),
    )
    point = (F.col("x"), F.col("y"))
    same = data.select(shape.endpoint_problem(F.col("a"), F.col("b"), point, point))
    assert [r[0] for r in values(same)] == ["EMPTY_ORIGIN", "EMPTY_DESTINATION", "SAME_PLACE", "SAME_PLACE", None]
    points = rows("x double, y double", (None, None), (1.0, None), (nan, 1.0), (91.0, 1.0), (90.0, -180.0))
    got = values(points.select(shape.coordinate_problem(F.col("x"), F.col("y"))))
    assert [r[0] for r in got] == [None, "INCOMPLETE", "NOT_FINITE", "OUT_OF_RANGE", None]
