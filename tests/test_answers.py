"""Whole route requests against hand-made answers, one for every way to fail."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from roadgrain import schemas as S
from roadgrain.operators import answers, routes as R
from roadgrain.plans.all_queries import QUERIES
from tests.conftest import SF_DIR, values

REQUESTS = (
    "request_id int, origin string, destination string, origin_lat double, origin_lon double, "
    "destination_lat double, destination_lon double"
)
ROUTE = {"distance": 8200, "duration": "600", "legs": [{"summary": "Mill Lane"}], "geometry": {"coordinates": [[5, 50], [6, 51]]}}


def place(lat, lon, name="There"):
    return json.dumps([{"lat": lat, "lon": lon, "display_name": name}])


PLACES = [
    (1, "A ", place("50.5", "5.5", "Aton"), None),
    (2, "b", json.dumps([{"lat": "51", "lon": "6"}]), None),
    (3, "slow", None, "Geocoding request timed out after 10s."),
    (4, "void", "[]", None),
    (5, "odd", place("north", "1"), None),
    (6, "far", place("10", "181"), None),
    (7, "a", place("1", "1", "a later answer"), None),
    (8, " ", place("1", "1"), None),
    (9, None, place("1", "1"), None),
]


@pytest.fixture
def answered(spark):
    def make(requests, responses):
        asked = [(i, *(list(r) + [None] * 6)[:6]) for i, r in enumerate(requests)]
        stored = [(i, json.dumps(r) if isinstance(r, dict) else r, None) for i, r in enumerate(responses) if r is not None]
        return answers.answer_requests(
            spark.createDataFrame(asked, REQUESTS),
            spark.createDataFrame(PLACES, "place_id int, query string, response string, message string"),
            spark.createDataFrame(stored, "request_id int, response string, message string"),
            salts=3,
        ).orderBy("request_id")

    return make


def good(**changes):
    return {"code": "Ok", "routes": [ROUTE | changes]}


def test_a_good_answer(answered):
    longer = ROUTE | {"distance": 9000, "duration": 900.0, "legs": []}
    row = answered([(" a", "B ")], [{"code": "Ok", "routes": [longer, ROUTE]}]).first()
    assert (row.status, row.error_code, row.error_message) == (200, None, None)
    assert tuple(row.origin) == ("a", "Aton", 50.5, 5.5) and tuple(row.destination) == ("B", "b", 51.0, 6.0)
    assert [(r.id, r.status, r.distance_km, r.duration_minutes, r.duration_basis) for r in row.routes] == [
        ("route_2", S.ROUTE_STATUS[0], 8.2, 10.0, S.DURATION_BASIS),
        ("route_1", S.ROUTE_STATUS[1], 9.0, 15.0, S.DURATION_BASIS),
    ]
    assert [tuple(p) for p in row.routes[0].geometry] == [(50.0, 5.0), (51.0, 6.0)]
    assert row.recommended_route_id == "route_2" and row.alternatives_available
    assert "saving approximately **5 minutes**" in row.recommendation_rationale


def test_given_coordinates_need_no_place(answered):
    row = answered([("nowhere", "b", 1.0, 2.0)], [good()]).first()
    assert row.status == 200 and tuple(row.origin) == ("nowhere", "nowhere", 1.0, 2.0)
    assert row.recommended_route_id is None and not row.alternatives_available


@pytest.mark.parametrize(
    "request_, code",
    [
        (("a", "b", 1.0), "INVALID_ORIGIN_COORDINATES"),
        (("", "b", 1.0, None, None, 2.0), "INVALID_ORIGIN_COORDINATES"),
        (("a", "b", None, None, None, 2.0), "INVALID_DESTINATION_COORDINATES"),
        ((" ", None), "EMPTY_ORIGIN"),
        ((None, "a"), "EMPTY_ORIGIN"),
        (("a", "\t"), "EMPTY_DESTINATION"),
        (("a", " A"), "SAME_PLACE"),
        (("a", "b", 1.0, 2.0, 1.0, 2.0), "SAME_PLACE"),
        (("slow", "void"), "GEOCODING_TIMEOUT"),
        (("a", "void"), "LOCATION_NOT_FOUND"),
        (("odd", "b"), "GEOCODING_SERVICE_ERROR"),
        (("missing", "b"), "GEOCODING_SERVICE_ERROR"),
        (("far", "b"), "INVALID_GEOCODING_RESPONSE"),
        (("a", "b", 91.0, 2.0), "INVALID_GEOCODING_RESPONSE"),
        (("a", "b", None, None, float("nan"), 2.0), "INVALID_GEOCODING_RESPONSE"),
    ],
)
def test_end_point_errors(answered, request_, code):
    row = answered([request_], [good()]).first()
    assert (row.error_code, row.status) == (code, S.REQUEST_STATUS[code]) and row.error_message
    assert row.origin is row.destination is row.routes is row.recommended_route_id is row.recommendation_rationale is None


@pytest.mark.parametrize(
    "response, code, words",
    [
        (None, "OSRM_SERVICE_ERROR", "stored"),
        ("<html>", "OSRM_SERVICE_ERROR", "parse"),
        ("[1]", "OSRM_SERVICE_ERROR", "Unexpected"),
        ({"code": "NoRoute", "message": "x"}, "ROUTE_NOT_FOUND", "NoRoute - x"),
        ({"code": "InvalidUrl", "message": "bad"}, "OSRM_SERVICE_ERROR", "InvalidUrl - bad"),
        ({"code": "InvalidUrl"}, "ROUTE_NOT_FOUND", "No route found"),
        ({"routes": []}, "ROUTE_NOT_FOUND", "None - "),
        ({"code": "Busy", "message": "Timeout"}, "OSRM_TIMEOUT", "Timeout"),
        ({"code": "Ok"}, "ROUTE_NOT_FOUND", "drivable"),
        ({"code": "Ok", "routes": []}, "ROUTE_NOT_FOUND", "drivable"),
        ({"code": "Ok", "routes": {}}, "ROUTE_NOT_FOUND", "drivable"),
        ({"code": "Ok", "routes": "x"}, "INVALID_ROUTING_RESPONSE", "routes list"),
        ({"code": "Ok", "routes": [5]}, "INVALID_ROUTING_RESPONSE", "parsed"),
        ({"code": "Ok", "routes": [None]}, "INVALID_ROUTING_RESPONSE", "parsed"),
        (good(distance="abc"), "INVALID_ROUTING_RESPONSE", "parsed"),
        (good(distance=None), "INVALID_ROUTING_RESPONSE", "parsed"),
        (good(duration=[1]), "INVALID_ROUTING_RESPONSE", "parsed"),
        (good(distance=-1000), "INVALID_ROUTING_RESPONSE", "distance"),
        (good(duration="nan"), "INVALID_ROUTING_RESPONSE", "duration"),
        (good(geometry={"coordinates": [[1, 2]]}), "INVALID_ROUTING_RESPONSE", "two points"),
        (good(geometry={"coordinates": [[181, 2], [1, 2]]}), "INVALID_ROUTING_RESPONSE", "coordinates"),
    ],
)
def test_routing_errors(answered, response, code, words):
    row = answered([("a", "b")], [response]).first()
    assert (row.error_code, row.status) == (code, S.REQUEST_STATUS[code]) and words in row.error_message
    assert row.routes is None


def test_messages_come_before_responses(spark):
    asked = spark.createDataFrame([(1, "a", "b", None, None, None, None)], REQUESTS)
    places = spark.createDataFrame(PLACES, "place_id int, query string, response string, message string")
    stored = spark.createDataFrame([(1, json.dumps(good()), "No drivable routes were found")], "request_id int, response string, message string")
    assert answers.answer_requests(asked, places, stored).first().error_code == "ROUTE_NOT_FOUND"
    assert answers.answer_requests(asked.where("false"), places, stored).count() == 0


def test_a_place_that_everybody_asks_for(spark):
    asked = spark.range(3000).select(
        F.col("id").cast("int").alias("request_id"),
        F.lit("a").alias("origin"),
        F.when(F.col("id") % 3 == 0, "b").otherwise("void").alias("destination"),
        *[F.lit(None).cast("double").alias(c) for c in ("origin_lat", "origin_lon", "destination_lat", "destination_lon")],
    )
    places = spark.createDataFrame(PLACES, "place_id int, query string, response string, message string")
    stored = asked.select("request_id", F.lit(json.dumps(good())).alias("response"), F.lit(None).cast("string").alias("message"))
    got = answers.answer_requests(asked, places, stored).groupBy("status").count()
    assert dict(values(got)) == {200: 1000, 404: 2000}


def test_every_error_occurs_in_the_query(spark):
    found = {r[0] for r in QUERIES["R5_request_answers"].run(spark, SF_DIR).select("error_code").distinct().collect()}
    assert found == {None, *S.REQUEST_STATUS}


@pytest.mark.parametrize(
    "written, metres",
    [(12.5, 12.5), ("12.5", 12.5), (" 7 ", 7.0), (True, 1.0), ("abc", None), (None, None), ("12.5d", None), ("0x1p3", None), ({}, None)],
)
def test_numbers_of_candidates(spark, written, metres):
    frame = spark.createDataFrame([(1, json.dumps(good(distance=written)))], "id int, response string")
    (row,) = R.candidate_rows(frame).collect()
    assert row.distance_meters == metres and (row.distance_km is None) == (metres is None)
    checked = R.validate_routes(R.parse_responses(frame)).first()
    assert checked.routes[0].distance_meters == metres
    assert checked.problem == (None if metres is not None else "UNREADABLE_ROUTE")


def test_an_unreadable_candidate_never_wins(spark):
    routes = [ROUTE | {"distance": "abc", "duration": 1}, ROUTE | {"duration": None}, ROUTE]
    frame = spark.createDataFrame([(1, json.dumps({"code": "Ok", "routes": routes}))], "id int, response string")
    ranked = R.ranked_rows(frame, "id").orderBy("rank").collect()
    assert [r.route_index for r in ranked] == [3, 2, 1] or [r.route_index for r in ranked] == [3, 1, 2]
    assert [r.route_index for r in R.rank_routes(R.parse_responses(frame)).first().routes][0] == 3
