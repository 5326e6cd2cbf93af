from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roadgrain import schemas as S
from roadgrain.functions import derive as D, text as X
from tests.conftest import values

NAN, INF = float("nan"), float("inf")


def test_threshold_class_edges(rows):
    levels = rows("x double", (None,), (NAN,), (59.999,), (60.0,), (89.999,), (90.0,), (-1.0,))
    assert values(levels.select(D.threshold_class(F.col("x")))) == [
        (None,),
        ("High",),
        ("Low",),
        ("Medium",),
        ("Medium",),
        ("High",),
        ("Low",),
    ]


@pytest.mark.parametrize("low, medium", [(60.0, 60.0), (90.0, 60.0), (NAN, 60.0)])
def test_cut_points_must_increase(low, medium, spark):
    with pytest.raises(ValueError):
        D.threshold_class(F.lit(1.0), low, medium)


def test_duration_text(rows):
    cases = [(0.0, "0 min"), (-3.0, "0 min"), (45.0, "1 min"), (1134.0, "19 min"), (3600.0, "1 hr"), (4320.0, "1 hr 12 min")]
    cases += [(1.0, "1 min"), (150.0, "2 min"), (210.0, "4 min"), (3599.0, "1 hr"), (7260.0, "2 hr 1 min")]
    data = rows("s double, want string", *cases)
    assert values(data.where(D.duration_text(F.col("s")) != F.col("want"))) == []


def test_distance_and_minutes_round_half_even(rows):
    data = rows("m double, s double", (18400.0, 90.0), (250.0, 2285.0), (350.0, 0.3))
    assert values(data.select(D.kilometres(F.col("m")), D.minutes_2dp(F.col("s")))) == [
        (18.4, 1.5),
        (0.2, 38.08),
        (0.4, 0.0),
    ]


def test_delay(rows):
    data = rows(
        "m double, km double, c string",
        (38.0, 18.4, "High"),
        (0.2, 1.0, "Low"),
        (2.5, 1.0, "Medium"),
        (-1.0, 1.0, "Low"),
        (NAN, 1.0, "Low"),
        (10.0, None, "Low"),
        (10.0, INF, "Low"),
        (10.0, 1.0, "Severe"),
        (10.0, 1.0, None),
    )
    delay = D.illustrative_delay(F.col("m"), F.col("km"), F.col("c"))
    got = values(data.select(delay.alias("d")).select("d.*"))
    assert got[:3] == [(38, 80, 111), (0, 0, 0), (3, 4, 33)]
    assert got[3:] == [(None, None, None)] * 6


def test_provider_errors(rows):
    data = rows(
        "m string, p string",
        ("Geocoding request for 'x' timed out after 10s.", "geocoding"),
        ("could not be resolved by the service", "geocoding"),
        ("No drivable routes were found", "routing"),
        ("No drivable routes were found", "geocoding"),
        ("returned HTTP 500", "routing"),
    )
    got = values(data.select(D.provider_error(F.col("m"), F.col("p")).alias("e")).select("e.*"))
    assert got == [
        (504, "GEOCODING_TIMEOUT"),
        (404, "LOCATION_NOT_FOUND"),
        (404, "ROUTE_NOT_FOUND"),
        (502, "GEOCODING_SERVICE_ERROR"),
        (502, "OSRM_SERVICE_ERROR"),
    ]


def test_load_ratio_class(rows):
    data = rows("v int", (90,), (89,), (70,), (69,), (45,), (44,))
    got = values(data.select(D.load_ratio_class(F.col("v"), F.lit(100))))
    assert [g[0] for g in got] == ["Severe", "High", "High", "Moderate", "Moderate", "Low"]


def test_finite_and_range(rows):
    data = rows("x double", (None,), (NAN,), (INF,), (-INF,), (90.0,), (90.1,))
    got = values(data.select(D.is_finite(F.col("x")), D.in_range(F.col("x"), -90, 90)))
    assert got == [(False, False)] * 4 + [(True, True), (True, False)]


def test_percentage_of_nothing_is_null(rows):
    data = rows("a int, b int", (1, 4), (0, 0))
    assert values(data.select(D.percentage(F.col("a"), F.col("b")))) == [(25.0,), (None,)]


def test_names_and_queries(rows):
    data = rows("t string", ("  Outer-Ring   Rd. (N)  ",), ("\tÉcole 9\n",), ("???",))
    assert values(data.select(X.normal_name(F.col("t")))) == [("outer ring rd n",), ("cole 9",), ("",)]
    assert values(data.select(X.query_key(F.col("t")))) == [("outer-ring   rd. (n)",), ("école 9",), ("???",)]
    assert values(data.select(X.is_meaningful_query(F.col("t")))) == [(True,), (True,), (False,)]
    names = rows("n string", ("Hebbal (North) Flyover (x), City, State",), ("Plain",), (" , b",))
    assert values(names.select(X.primary_place_name(F.col("n")))) == [("hebbal flyover",), ("plain",), ("",)]


def test_localised_query(rows):
    data = rows("q string", ("Kor",), ("Kor, BANGALORE",), ("bengaluru north",))
    got = values(data.select(X.localised_query(F.col("q"), S.CITY_SPELLINGS, S.CITY_SUFFIX)))
    assert got == [("Kor, Bengaluru, Karnataka, India",), ("Kor, BANGALORE",), ("bengaluru north",)]


def test_decimal_numbers(rows):
    good = {"12.5": 12.5, " -3 ": -3.0, ".5": 0.5, "7.": 7.0, "1e3": 1000.0, "+2E-1": 0.2}
    bad = ["12.5d", "3f", "0x1p3", "abc", "", "1,5", "e3", "--1", None]
    data = rows("cell string", *[(cell,) for cell in [*good, *bad]])
    assert dict(values(data.select("cell", D.decimal_number(F.col("cell"))))) == {**good, **dict.fromkeys(bad)}
