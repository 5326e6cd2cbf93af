from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from roadgrain.functions.text import normal_name
from roadgrain.operators import places as P, routes as R
from tests.conftest import values

RESPONSE = {
    "code": "Ok",
    "routes": [
        {
            "distance": 7300.0,
            "duration": 540.0,
            "legs": [{"summary": "Canal Street"}],
            "geometry": {"coordinates": [[4.11, 51.02], [4.19, 51.08]]},
        },
        {
            "distance": 9100.0,
            "duration": 845.0,
            "legs": [{"summary": "Hill Tunnel"}],
            "geometry": {"coordinates": [[4.11, 51.02], [4.3, 51.2], [4.19, 51.08]]},
        },
    ],
}


def route(distance, duration, summary="r", coordinates=((77.0, 12.0), (77.1, 12.1))):
    return {
        "distance": distance,
        "duration": duration,
        "legs": [{"summary": summary}],
        "geometry": {"coordinates": [list(c) for c in coordinates]},
    }


@pytest.fixture
def responses(spark):
    def make(*documents):
        texts = [d if isinstance(d, str) else json.dumps(d) for d in documents]
        return spark.createDataFrame(list(enumerate(texts)), "id int, response string")

    return make


def answer(frame):
    return R.recommend(R.rank_routes(R.parse_responses(frame)))


def test_parse(responses):
    parsed = values(R.candidate_rows(responses(RESPONSE)))
    assert [(p[1], p[2], p[4], p[6]) for p in parsed] == [
        (1, "Canal Street", 7.3, "9 min"),
        (2, "Hill Tunnel", 9.1, "14 min"),
    ]
    assert tuple(parsed[0][7][0]) == (51.02, 4.11)
    in_arrays = R.parse_responses(responses(RESPONSE)).select("id", F.inline("routes"))
    assert values(in_arrays) == parsed


def test_defaults_of_missing_parts(responses):
    frame = responses({"code": "Ok", "routes": [{"legs": [{"summary": "  "}], "geometry": {"coordinates": [[1.0]]}}, {}]})
    got = values(R.candidate_rows(frame), "route_index", "summary", "distance_meters", "duration_formatted", "coordinates")
    assert got == [(1, "Route 1", 0.0, "0 min", []), (2, "Route 2", 0.0, "0 min", [])]


def test_ranking_is_by_duration(responses):
    turned = {"code": "Ok", "routes": RESPONSE["routes"][::-1]}
    row = answer(responses(turned)).first()
    assert [(r.rank, r.summary, r.status) for r in row.routes] == [
        (1, "Canal Street", "Recommended"),
        (2, "Hill Tunnel", "Alternative"),
    ]
    assert row.recommended_route_id == "route_2" and row.alternatives_available
    assert row.routes[0].recommendation_reason.endswith("(saves ~5 min vs alternative via Hill Tunnel).")
    assert row.routes[1].recommendation_reason == "Alternative route via Hill Tunnel (+5 min, +1.8 km vs Recommended)."
    assert "saving approximately **5 minutes**" in row.recommendation_rationale


def test_single_route(responses):
    row = answer(responses({"code": "Ok", "routes": RESPONSE["routes"][:1]})).first()
    assert row.routes[0].status == "Available Route"
    assert row.recommended_route_id is None and row.selected_route_id == "route_1" and not row.alternatives_available
    assert "Only one route was returned" in row.recommendation_rationale


def test_same_minute_prefers_the_shorter_and_may_be_slower(responses):
    row = answer(responses({"code": "Ok", "routes": [route(5000.0, 600.0, "fast"), route(4000.0, 659.0, "short")]})).first()
    assert [r.summary for r in row.routes] == ["short", "fast"]
    assert "shorter travel distance (4.0 km)" in row.routes[0].recommendation_reason
    assert row.routes[1].recommendation_reason == "Alternative route via fast (+-1 min, +1.0 km vs Recommended)."
    assert "**4.0 km** vs 5.0 km on **fast**" in row.recommendation_rationale


def test_exact_tie_keeps_input_order(responses):
    row = answer(responses({"code": "Ok", "routes": [route(1.0, 60.0, f"r{i}") for i in range(5)]})).first()
    assert [r.route_index for r in row.routes] == [1, 2, 3, 4, 5]


def test_no_routes(responses):
    row = answer(responses({"code": "Ok", "routes": []})).first()
    assert row.routes == [] and row.recommendation_rationale == "No routes available to evaluate."


def test_validity(responses):
    bad_point, one_point = [(181, 12), (77.6, 12.9)], [(77.0, 12.0)]
    frame = responses(
        RESPONSE,
        {"code": "Ok", "routes": [route(1.0, 1.0), route(1.0, 1.0, coordinates=bad_point)]},
        {"code": "Ok", "routes": [route(1.0, 1.0, coordinates=one_point)]},
        {"code": "Ok", "routes": [route(-100.0, 1.0)]},
        {"code": "Ok", "routes": [route(1.0, -1.0)]},
        {"code": "NoRoute"},
        {"code": "Ok"},
        {"code": "Ok", "routes": []},
        "not json",
    )
    got = values(R.validate_routes(R.parse_responses(frame)).orderBy("id"), "problem")
    assert [g[0] for g in got] == [
        None,
        "INVALID_COORDINATES",
        "TOO_FEW_POINTS",
        "INVALID_DISTANCE",
        "INVALID_DURATION",
        "INVALID_RESPONSE",
        "MISSING_ROUTES",
        "ROUTE_NOT_FOUND",
        "INVALID_RESPONSE",
    ]


def test_bounds(responses):
    def point(lat, lon):
        return F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon"))

    ranked = R.rank_routes(R.parse_responses(responses(RESPONSE, {"code": "Ok", "routes": []})))
    got = values(R.route_bounds(ranked, point(12.0, 77.0), point(12.5, 78.0), "id"))
    assert got == [(0, 12.0, 51.2, 4.11, 78.0, 12.25, 77.5), (1, 12.0, 12.5, 77.0, 78.0, 12.25, 77.5)]


# ------------------------------------------------------------------------ places
def test_suggestions_and_first_places(spark):
    entries = [
        {"lat": "12.9", "lon": "77.6", "display_name": "Koramangala"},
        {"lat": "x", "lon": "77.6", "display_name": "bad"},
        {"lat": "12.9", "lon": "190", "display_name": "far"},
        {"lat": "12.9", "lon": "77.6", "display_name": " "},
        {"lat": "12.9", "lon": "77.6"},
    ]
    searches = [(1, " Kor ", json.dumps(entries)), (2, "x", "[]"), (3, " ", json.dumps(entries))]
    searches += [(4, "y", json.dumps(entries[2:])), (5, "z", json.dumps(entries[4:]))]
    frame = spark.createDataFrame(searches, "id int, query string, response string")
    assert values(P.clean_suggestions(frame.where("id = 1").drop("query")), "position", "display_name") == [(1, "Koramangala")]
    got = values(P.first_places(frame).orderBy("id"), "query", "display_name", "error")
    assert got == [
        ("Kor", "Koramangala", None),
        ("x", None, "LOCATION_NOT_FOUND"),
        ("", None, "EMPTY_QUERY"),
        ("y", None, "INVALID_GEOCODING_RESPONSE"),
        ("z", "z", None),
    ]


def test_one_answer_for_a_hot_query(spark):
    searches = [(i, " KOR" if i % 2 else "kor", f"answer {i}") for i in range(2000)] + [(2000, "other", None)]
    frame = spark.createDataFrame(searches, "id int, query string, answer string").repartition(4)
    got = P.one_answer_per_query(frame, "id")
    assert got.count() == 2001
    assert values(got.groupBy("query_key").agg(F.min("answer"), F.max("answer"), F.max("searches")).orderBy("query_key")) == [
        ("kor", "answer 0", "answer 0", 2000),
        ("other", None, None, 1),
    ]


def test_corridor_matching_equals_brute_force(spark):
    roads = [(i, name) for i, name in enumerate(["Outer-Ring Rd", "String Street", "M.G. Road", "", None, "hosur rd", "Ring"])]
    roads += [(0, "Hosur Road"), (7, "OUTER RING"), (8, "x")]
    corridors = [(2, "orr", ["Outer Ring", "ring rd"]), (1, "hosur", ["HOSUR"]), (3, "none", ["!!", ""]), (4, "ring", ["ring"])]
    frame = spark.createDataFrame(roads, "request_id int, name string")
    table = spark.createDataFrame(corridors, "position int, corridor_id string, keywords array<string>")
    clean = {t: n for t, n in values(spark.createDataFrame([(t,) for t in {r[1] for r in roads} if t] + [
        (k,) for c in corridors for k in c[2]], "t string").select("t", normal_name(F.col("t"))))}
    expected = set()
    for request in {r[0] for r in roads}:
        names = [clean[n] for r, n in roads if r == request and n]
        hits = {c for _, c, words in corridors for w in words if clean[w] and any(clean[w] in n for n in names)}
        expected |= {(request, c, False) for c in hits} or {(request, "hosur", True)}
    assert set(values(P.match_corridors(frame, table))) == expected


def test_only_the_first_leg_counts(spark):
    document = {"code": "Ok", "routes": [{"legs": [{"steps": [{"name": "A"}, {}]}, {"steps": [{"name": "B"}]}]}, {"legs": []}]}
    frame = spark.createDataFrame([(1, json.dumps(document)), (2, "{}")], "request_id int, response string")
    parsed = frame.select("request_id", F.from_json("response", R.S.ROUTE_RESPONSE_SCHEMA).alias("d"))
    roads = P.first_leg_roads(parsed.select("request_id", F.col("d.routes").alias("routes")), "request_id")
    assert sorted(values(roads)) == [(1, ""), (1, "A"), (2, "")]


def test_merged_suggestions(spark):
    results = [("kor", 1, "Koramangala, City"), ("kor", 2, " KORAMANGALA, city "), ("kor", 3, "Korba"), ("heb", 1, "Hebbal (N), X")]
    frame = spark.createDataFrame(results, "query string, position int, display_name string")
    asked = spark.createDataFrame([("whi",), ("zzz",)], "query string")
    hints = ["Koramangala", "Korattur", "Hebbal", "Whitefield"]
    got = sorted(values(P.merge_suggestions(frame, hints, asked), "query", "source", "display_name"))
    assert got == [
        ("heb", "provider", "Hebbal (N), X"),
        ("kor", "hint", "Korattur, Bengaluru"),
        ("kor", "provider", "Koramangala, City"),
        ("kor", "provider", "Korba"),
        ("whi", "hint", "Whitefield, Bengaluru"),
    ]


def test_meaningful_queries(rows):
    assert values(P.meaningful(rows("query string", ("ab",), ("a b c",), ("ಬೆಂಗಳೂರು",)))) == [("a b c",), ("ಬೆಂಗಳೂರು",)]
