"""Registered queries: stored route responses, place answers, name matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadgrain import schemas as S
from roadgrain.operators import answers, places as P, routes as R
from roadgrain.operators.rows import unfold
from roadgrain.plans.registry import query, sql_text
from roadgrain.plans.shape_queries import sql_duration
from roadgrain.sources.given import table


# ---------------------------------------------------------------- route responses
def _responses(spark, sf_dir, faults: bool = False, odd_numbers: bool = False) -> DataFrame:
    """One stored response per order with one to three candidates.

    Distances and durations follow from the price; some candidates tie in their minute
    or in everything, lack a distance or a summary, or carry a one-number point. With
    ``faults`` some responses break a validity rule, with ``odd_numbers`` some first distances are
    null, a word, or a number written as text.
    """
    key, customer, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    metres = price / 10.0 + 0.0037
    seconds = F.floor(price / 100.0).cast("double")
    lon, lat = F.lit(70.0) + (customer % 100) / F.lit(10.0), F.lit(10.0) + (key % 50) / F.lit(10.0)
    far_lat = F.when(key % 29 == 0, F.lit(95.0)).otherwise(lat + 1.0) if faults else lat + 1.0
    first_seconds = F.when(key % 37 == 0, F.lit(-5.0)).otherwise(seconds) if faults else seconds

    def written(number, plain):
        """A distance in JSON: absent where it is null, else as a number or oddly."""
        text = number.cast("string")
        if not plain:
            quoted = F.concat(F.lit('"'), text, F.lit('"'))
            odd = F.when(key % 19 == 1, '"abc"').when(key % 19 == 2, "null").when(key % 19 == 3, quoted).otherwise(text)
            text = F.when(number.isNotNull(), odd)
        return F.parse_json(text)

    def candidate(distance, duration, summary, last_point, plain=True):
        points = F.array(F.array(lon, lat), F.array(lon + 1.0, last_point), F.array(lon))
        if faults:
            points = F.when(key % 31 == 0, F.array(F.array(lon, lat))).otherwise(points)
        legs = F.array(F.struct(summary.alias("summary"))) if summary is not None else F.lit(None).cast(
            "array<struct<summary:string>>"
        )
        return F.struct(
            (written(distance, plain) if odd_numbers else distance).alias("distance"),
            duration.alias("duration"),
            legs.alias("legs"),
            F.struct(points.alias("coordinates")).alias("geometry"),
        )

    candidates = F.array(
        candidate(
            F.when(key % 17 != 0, metres), first_seconds, F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")), far_lat, False
        ),
        candidate(
            metres * (F.lit(1.0) + ((customer % 5) - 2) * F.lit(0.02)),
            seconds + ((key % 11) - 5) * F.lit(20.0),
            F.when(key % 4 == 0, " ").otherwise(F.col("o_orderstatus")),
            lat,
        ),
        candidate(metres * 1.1, seconds + 90.0, None, lat),
    )
    count = (key % 3 + 1).cast("int")
    code = F.lit("Ok")
    if faults:
        code = F.when(key % 41 == 0, "NoRoute").otherwise(code)
        count = F.when(key % 43 == 0, F.lit(0)).otherwise(count)
    body = F.slice(candidates, F.lit(1), count)
    if faults:
        body = F.when(key % 47 != 0, body)
    return table(spark, sf_dir, "orders").select(
        key.alias("request_id"), F.to_json(F.struct(code.alias("code"), body.alias("routes"))).alias("response")
    )


_CANDIDATES_SQL = f"""b AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS p, o_orderstatus AS st,
    o_totalprice / 10e0 + 0.0037e0 AS m, floor(o_totalprice / 100e0)::DOUBLE AS s,
    70e0 + (o_custkey % 100) / 10e0 AS lon, 10e0 + (o_orderkey % 50) / 10e0 AS lat FROM orders),
  r AS (SELECT k AS request_id, CAST(1 AS INTEGER) AS route_index, p AS summary, CASE WHEN k % 17 <> 0 THEN m ELSE 0e0 END AS metres,
      s AS seconds, lat + 1e0 AS last_lat, lon, lat FROM b
    UNION ALL SELECT k, 2, CASE WHEN k % 4 = 0 THEN 'Route 2' ELSE st END, m * (1e0 + ((c % 5) - 2) * 0.02e0),
      s + ((k % 11) - 5) * 20e0, lat, lon, lat FROM b WHERE k % 3 >= 1
    UNION ALL SELECT k, 3, 'Route 3', m * 1.1e0, s + 90e0, lat, lon, lat FROM b WHERE k % 3 = 2),
  f AS (SELECT *, round_even(metres / 1000e0, 1) AS km, {sql_duration('seconds')} AS txt FROM r),
  ranked AS (SELECT *, CAST(row_number() OVER w AS INTEGER) AS rnk, count(*) OVER (PARTITION BY request_id) AS n
    FROM f WINDOW w AS (PARTITION BY request_id ORDER BY floor(seconds / 60e0), metres, route_index)),
  top AS (SELECT request_id, max(CASE WHEN rnk = 1 THEN seconds END) AS s1, max(CASE WHEN rnk = 2 THEN seconds END) AS s2,
      max(CASE WHEN rnk = 1 THEN km END) AS km1, max(CASE WHEN rnk = 2 THEN km END) AS km2,
      max(CASE WHEN rnk = 1 THEN summary END) AS sum1, max(CASE WHEN rnk = 2 THEN summary END) AS sum2,
      max(CASE WHEN rnk = 1 THEN txt END) AS txt1, max(CASE WHEN rnk = 2 THEN txt END) AS txt2,
      max(CASE WHEN rnk = 1 THEN route_index END) AS id1, max(n) AS total FROM ranked GROUP BY request_id)"""

#: The first candidate's distance can't be read.
_ODD_SQL = "(route_index = 1 AND request_id % 17 <> 0 AND request_id % 19 IN (1, 2))"
_T = {name: sql_text(text) for name, text in S.ROUTE_TEXT.items()}
_SAVED_SQL = "CAST(round_even((s2 - s1) / 60e0, 0) AS BIGINT)"


@query(
    "R1_parsed_routes",
    f"WITH {_CANDIDATES_SQL} SELECT request_id, route_index, summary, "
    f"CASE WHEN NOT {_ODD_SQL} THEN metres END AS distance_meters, CASE WHEN NOT {_ODD_SQL} THEN km END AS distance_km, "
    "seconds AS duration_seconds, txt AS duration_formatted, CAST(2 AS INTEGER) AS point_count, lat AS first_lat, lon AS first_lon, "
    "last_lat FROM f",
)
def parsed_routes(spark, sf_dir):
    return R.candidate_rows(_responses(spark, sf_dir, odd_numbers=True)).select(
        "request_id",
        "route_index",
        "summary",
        "distance_meters",
        "distance_km",
        "duration_seconds",
        "duration_formatted",
        F.size("coordinates").alias("point_count"),
        F.col("coordinates")[0]["lat"].alias("first_lat"),
        F.col("coordinates")[0]["lon"].alias("first_lon"),
        F.col("coordinates")[1]["lat"].alias("last_lat"),
    )


def _ranked(spark, sf_dir) -> DataFrame:
    return R.rank_routes(R.parse_responses(_responses(spark, sf_dir)))


def _ranked_rows(spark, sf_dir) -> DataFrame:
    return R.ranked_rows(_responses(spark, sf_dir), "request_id")


@query(
    "R2_route_ranks",
    f'WITH {_CANDIDATES_SQL} SELECT request_id, rnk AS "rank", route_index FROM ranked',
)
def route_ranks(spark, sf_dir):
    return _ranked_rows(spark, sf_dir).select("request_id", "rank", "route_index")


@query(
    "R3_route_status",
    f"WITH {_CANDIDATES_SQL} SELECT request_id, route_index, CASE WHEN n = 1 THEN 'Available Route' "
    "WHEN rnk = 1 THEN 'Recommended' ELSE 'Alternative' END AS status FROM ranked",
)
def route_status(spark, sf_dir):
    return _ranked_rows(spark, sf_dir).select("request_id", "route_index", "status")


@query(
    "R4_route_reasons",
    f"WITH {_CANDIDATES_SQL} SELECT request_id, route_index, round_even(seconds / 60e0, 2) AS duration_minutes, "
    f"CASE WHEN n = 1 THEN printf({_T['only_reason']}, summary, txt, km) "
    f"WHEN rnk = 1 AND {_SAVED_SQL} > 0 THEN printf({_T['faster_reason']}, {_SAVED_SQL}, sum2) "
    f"WHEN rnk = 1 THEN printf({_T['shorter_reason']}, txt, km) "
    f"ELSE printf({_T['alternative_reason']}, summary, CAST(round_even((seconds - s1) / 60e0, 0) AS BIGINT), "
    "round_even(km - km1, 1)) END AS recommendation_reason FROM ranked JOIN top USING (request_id)",
)
def route_reasons(spark, sf_dir):
    return _ranked_rows(spark, sf_dir).select(
        "request_id", "route_index", "duration_minutes", "recommendation_reason"
    )


@query(
    "R5_route_recommendations",
    f"WITH {_CANDIDATES_SQL} SELECT request_id, CAST(total AS INTEGER) AS route_count, "
    "CASE WHEN total > 1 THEN 'route_' || id1 END AS recommended_route_id, 'route_' || id1 AS selected_route_id, "
    "total > 1 AS alternatives_available, "
    f"CASE WHEN total = 1 THEN printf({_T['only_rationale']}, sum1, txt1, km1) "
    f"WHEN {_SAVED_SQL} > 0 THEN printf({_T['faster_rationale']}, sum1, txt1, km1, {_SAVED_SQL}, sum2, txt2) "
    f"ELSE printf({_T['shorter_rationale']}, sum1, km1, km2, sum2) END AS recommendation_rationale FROM top",
)
def route_recommendations(spark, sf_dir):
    answered = R.recommend(_ranked(spark, sf_dir))
    return answered.select(
        "request_id",
        F.size("routes").alias("route_count"),
        "recommended_route_id",
        "selected_route_id",
        "alternatives_available",
        "recommendation_rationale",
    )


_RESPONSE_FAULT_SQL = (
    "CASE WHEN o_orderkey % 41 = 0 THEN 'INVALID_RESPONSE' WHEN o_orderkey % 47 = 0 THEN 'MISSING_ROUTES' "
    "WHEN o_orderkey % 43 = 0 THEN 'ROUTE_NOT_FOUND' END"
)


_ROUTE_FAULT_SQL = (
    "CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 19 IN (1, 2) THEN 'UNREADABLE_ROUTE' "
    "WHEN o_orderkey % 37 = 0 THEN 'INVALID_DURATION' "
    "WHEN o_orderkey % 31 = 0 THEN 'TOO_FEW_POINTS' WHEN o_orderkey % 29 = 0 THEN 'INVALID_COORDINATES' "
    "WHEN o_orderkey % 3 >= 1 AND floor(o_totalprice / 100e0) + ((o_orderkey % 11) - 5) * 20 < 0 THEN 'INVALID_DURATION' END"
)


@query(
    "R6_route_validity",
    f"SELECT o_orderkey AS request_id, coalesce({_RESPONSE_FAULT_SQL}, {_ROUTE_FAULT_SQL}) AS problem FROM orders",
)
def route_validity(spark, sf_dir):
    checked = R.validate_routes(R.parse_responses(_responses(spark, sf_dir, faults=True, odd_numbers=True)))
    return checked.select("request_id", "problem")


@query(
    "R7_response_validity",
    f"SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 41 = 0 THEN 'NoRoute' ELSE 'Ok' END AS code, "
    f"{_RESPONSE_FAULT_SQL} AS response_problem FROM orders",
)
def response_validity(spark, sf_dir):
    parsed = R.parse_responses(_responses(spark, sf_dir, faults=True))
    return parsed.select("request_id", "code", "response_problem")


@query(
    "A18_route_bounds",
    f"WITH {_CANDIDATES_SQL} SELECT request_id, min(least(lat, last_lat, 11e0)) AS min_lat, max(greatest(lat, last_lat, 12e0)) AS max_lat, "
    "min(least(lon, 75e0)) AS min_lon, max(greatest(lon + 1e0, 76e0)) AS max_lon, 11.5e0 AS center_lat, 75.5e0 AS center_lon "
    "FROM f GROUP BY request_id",
)
def route_bounds(spark, sf_dir):
    def end(lat: float, lon: float):
        return F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon"))

    return R.route_bounds(_ranked(spark, sf_dir), end(11.0, 75.0), end(12.0, 76.0), "request_id")


# ---------------------------------------------------------------- whole requests
_SPOKEN = {
    "place_timeout": "Geocoding request timed out after 10s.",
    "place_network": "Network error connecting to Nominatim geocoding service: refused",
    "route_timeout": "OSRM routing calculation timed out after 15s.",
    "route_network": "Network error connecting to OSRM routing service: refused",
}


def _requests(spark, sf_dir) -> DataFrame:
    """A request for each order between two supplier names; some give coordinates, halves of them or no names."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")

    def name(number):
        return F.concat(F.lit("Supplier#"), F.lpad(number.cast("string"), 9, "0"))

    origin, destination = name(customer % 12 + 1), name(F.floor(customer / 12) % 12 + 1)
    latitude, longitude = F.lit(10.0) + key % 40, F.lit(70.0) + customer % 20
    return table(spark, sf_dir, "orders").select(
        key.alias("request_id"),
        F.when(key % 53 == 0, "  ").when(key % 2 == 0, F.concat(F.lit(" "), F.upper(origin))).otherwise(origin).alias("origin"),
        F.when(key % 59 == 0, F.lit(None)).otherwise(F.concat(destination, F.lit("  "))).alias("destination"),
        F.when(key % 61 == 0, 95.0).when(key % 5 == 0, latitude).alias("origin_lat"),
        F.when((key % 5 == 0) & (key % 67 != 0) | (key % 61 == 0), longitude).alias("origin_lon"),
        F.when((key % 4 == 1) & (key % 71 != 0), latitude + 1.0).alias("destination_lat"),
        F.when(key % 4 == 1, longitude).alias("destination_lon"),
    )


def _stored_places(spark, sf_dir) -> DataFrame:
    """A place answer for each supplier name; some are messages, empty, unreadable or out of range."""
    key = F.col("s_suppkey")
    kind = key % 12
    entry = F.struct(
        F.when(kind == 6, "x").when(kind == 8, "91.0").otherwise(F.concat(F.lit("12."), key.cast("string"))).alias("lat"),
        F.lit("77.5").alias("lon"),
        F.when(kind != 7, F.concat("s_name", F.lit(", City"))).alias("display_name"),
    )
    return table(spark, sf_dir, "supplier").select(
        key.alias("place_id"),
        F.col("s_name").alias("query"),
        F.when(kind == 5, "[]").otherwise(F.to_json(F.array(entry))).alias("response"),
        F.when(kind == 3, _SPOKEN["place_timeout"]).when(kind == 9, _SPOKEN["place_network"]).alias("message"),
    )


def _stored_routes(spark, sf_dir) -> DataFrame:
    """The responses with faults, some replaced by a message or by text that is no JSON, some not stored."""
    key = F.col("request_id")
    return _responses(spark, sf_dir, faults=True, odd_numbers=True).where(key % 73 != 0).select(
        "request_id",
        F.when(key % 79 == 0, "<html>").otherwise(F.col("response")).alias("response"),
        F.when(key % 83 == 0, _SPOKEN["route_timeout"]).when(key % 89 == 0, _SPOKEN["route_network"]).alias("message"),
    )


def _first_of(*cases: tuple[str, str, str]) -> tuple[str, str]:
    """SQL for the code and the message of the first condition that holds."""
    codes = " ".join(f"WHEN {condition} THEN {code}" for condition, code, _ in cases)
    messages = " ".join(f"WHEN {condition} THEN {message}" for condition, _, message in cases)
    return f"CASE {codes} END", f"CASE {messages} END"


def _end_cases(end: str) -> list[tuple[str, str, str]]:
    given, number = f"({end}_lat IS NOT NULL AND {end}_lon IS NOT NULL)", f"{end}_no % 12"
    unresolved = f"'Location ''' || {end}_name || ''' could not be resolved by OpenStreetMap Nominatim.'"
    cases = [
        (f"{given} AND abs({end}_lat) > 90", "INVALID_GEOCODING_RESPONSE", None),
        (f"NOT {given} AND {end}_no IS NULL", "GEOCODING_SERVICE_ERROR", "No answer is stored for this place."),
        (f"NOT {given} AND {number} = 3", "GEOCODING_TIMEOUT", _SPOKEN["place_timeout"]),
        (f"NOT {given} AND {number} = 9", "GEOCODING_SERVICE_ERROR", _SPOKEN["place_network"]),
        (f"NOT {given} AND {number} = 6", "GEOCODING_SERVICE_ERROR", "Failed to parse geocoding response."),
        (f"NOT {given} AND {number} = 8", "INVALID_GEOCODING_RESPONSE", None),
    ]
    told = [(c, sql_text(code), sql_text(text or S.REQUEST_MESSAGE[code])) for c, code, text in cases]
    return [*told, (f"NOT {given} AND {number} = 5", "'LOCATION_NOT_FOUND'", unresolved)]


def _own(code: str, condition: str) -> tuple[str, str, str]:
    return condition, sql_text(code), sql_text(S.REQUEST_MESSAGE[code])


_NO_ROUTE = "OSRM routing response: NoRoute - No route found."
_CODE_SQL, _MESSAGE_SQL = _first_of(
    _own("INVALID_ORIGIN_COORDINATES", "(origin_lat IS NULL) <> (origin_lon IS NULL)"),
    _own("INVALID_DESTINATION_COORDINATES", "(destination_lat IS NULL) <> (destination_lon IS NULL)"),
    _own("EMPTY_ORIGIN", "trim(origin) = ''"),
    _own("EMPTY_DESTINATION", "destination IS NULL"),
    _own(
        "SAME_PLACE",
        "lower(trim(origin)) = lower(trim(destination)) "
        "OR coalesce(origin_lat = destination_lat AND origin_lon = destination_lon, false)",
    ),
    *_end_cases("origin"),
    *_end_cases("destination"),
    ("k % 73 = 0", "'OSRM_SERVICE_ERROR'", "'No answer is stored for this request.'"),
    ("k % 83 = 0", "'OSRM_TIMEOUT'", sql_text(_SPOKEN["route_timeout"])),
    ("k % 89 = 0", "'OSRM_SERVICE_ERROR'", sql_text(_SPOKEN["route_network"])),
    ("k % 79 = 0", "'OSRM_SERVICE_ERROR'", "'Failed to parse OSRM JSON response.'"),
    ("response_fault = 'INVALID_RESPONSE'", "'ROUTE_NOT_FOUND'", sql_text(_NO_ROUTE)),
    _own("ROUTE_NOT_FOUND", "response_fault IS NOT NULL"),
    (
        "route_fault IS NOT NULL",
        "'INVALID_ROUTING_RESPONSE'",
        "CASE route_fault " + " ".join(f"WHEN '{k}' THEN {sql_text(v)}" for k, v in S.ROUTING_MESSAGE.items()) + " END",
    ),
)
_STATUS_SQL = "CASE error_code " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in S.REQUEST_STATUS.items()) + " ELSE 200 END"


def _end_sql(end: str) -> str:
    given = f"{end}_lat IS NOT NULL AND {end}_lon IS NOT NULL"
    values = {
        "display_name": (f"trim({end})", f"CASE WHEN {end}_no % 12 = 7 THEN {end}_name ELSE {end}_name || ', City' END"),
        "latitude": (f"{end}_lat", f"CAST('12.' || {end}_no AS DOUBLE)"),
        "longitude": (f"{end}_lon", "77.5e0"),
    }
    return ", ".join(
        f"CASE WHEN error_code IS NOT NULL THEN NULL WHEN {given} THEN {own} ELSE {found} END AS {end}_{name}"
        for name, (own, found) in values.items()
    )


@query(
    "R5_request_answers",
    f"""WITH {_CANDIDATES_SQL},
  q AS (SELECT o_orderkey AS k, 'Supplier#' || lpad(CAST(o_custkey % 12 + 1 AS VARCHAR), 9, '0') AS o,
      'Supplier#' || lpad(CAST((o_custkey // 12) % 12 + 1 AS VARCHAR), 9, '0') AS t,
      10e0 + o_orderkey % 40 AS a, 70e0 + o_custkey % 20 AS b, {_RESPONSE_FAULT_SQL} AS response_fault,
      {_ROUTE_FAULT_SQL} AS route_fault FROM orders),
  asked AS (SELECT k, response_fault, route_fault,
      CASE WHEN k % 53 = 0 THEN '  ' WHEN k % 2 = 0 THEN ' ' || upper(o) ELSE o END AS origin,
      CASE WHEN k % 59 <> 0 THEN t || '  ' END AS destination,
      CASE WHEN k % 61 = 0 THEN 95e0 WHEN k % 5 = 0 THEN a END AS origin_lat,
      CASE WHEN k % 5 = 0 AND k % 67 <> 0 OR k % 61 = 0 THEN b END AS origin_lon,
      CASE WHEN k % 4 = 1 AND k % 71 <> 0 THEN a + 1 END AS destination_lat, CASE WHEN k % 4 = 1 THEN b END AS destination_lon
    FROM q),
  met AS (SELECT asked.*, s1.s_suppkey AS origin_no, s1.s_name AS origin_name, s2.s_suppkey AS destination_no,
      s2.s_name AS destination_name FROM asked LEFT JOIN supplier s1 ON lower(s1.s_name) = lower(trim(origin))
      LEFT JOIN supplier s2 ON lower(s2.s_name) = lower(trim(destination))),
  judged AS (SELECT *, {_CODE_SQL} AS error_code, {_MESSAGE_SQL} AS error_message FROM met)
  SELECT k AS request_id, CAST({_STATUS_SQL} AS INTEGER) AS status, error_code, error_message,
    {_end_sql("origin")}, {_end_sql("destination")},
    CASE WHEN error_code IS NULL THEN CAST(total AS INTEGER) END AS route_count,
    CASE WHEN error_code IS NULL THEN 'route_' || id1 END AS first_route_id,
    CASE WHEN error_code IS NULL THEN '{S.DURATION_BASIS}' END AS duration_basis,
    CASE WHEN error_code IS NULL THEN km1 END AS first_distance_km, CASE WHEN error_code IS NULL THEN txt1 END AS first_duration,
    CASE WHEN error_code IS NULL AND total > 1 THEN 'route_' || id1 END AS recommended_route_id,
    CASE WHEN error_code IS NULL THEN total > 1 END AS alternatives_available,
    CASE WHEN error_code IS NOT NULL THEN NULL WHEN total = 1 THEN printf({_T['only_rationale']}, sum1, txt1, km1)
      WHEN {_SAVED_SQL} > 0 THEN printf({_T['faster_rationale']}, sum1, txt1, km1, {_SAVED_SQL}, sum2, txt2)
      ELSE printf({_T['shorter_rationale']}, sum1, km1, km2, sum2) END AS recommendation_rationale
  FROM judged JOIN top ON top.request_id = judged.k""",
)
def request_answers(spark, sf_dir):
    answered = answers.answer_requests(
        _requests(spark, sf_dir), _stored_places(spark, sf_dir), _stored_routes(spark, sf_dir)
    )
    first = F.try_element_at("routes", F.lit(1))
    ends = [
        F.col(f"{end}.{part}").alias(f"{end}_{part}")
        for end in answers.ENDS
        for part in ("display_name", "latitude", "longitude")
    ]
    return answered.select(
        "request_id",
        "status",
        "error_code",
        "error_message",
        *ends,
        F.when(F.col("routes").isNotNull(), F.size("routes")).alias("route_count"),
        first["id"].alias("first_route_id"),
        first["duration_basis"].alias("duration_basis"),
        first["distance_km"].alias("first_distance_km"),
        first["duration_formatted"].alias("first_duration"),
        "recommended_route_id",
        "alternatives_available",
        "recommendation_rationale",
    )


# ------------------------------------------------------------------ place answers
_PLACES_SQL = """pl AS (SELECT p_partkey AS k, p_name AS n, p_brand AS b, p_size AS z FROM part),
  e AS (SELECT k, CAST(1 AS INTEGER) AS position, CASE WHEN k % 9 = 0 THEN '   ' ELSE n || ', ' || b END AS display_name,
      CASE WHEN k % 7 = 0 THEN 'north' WHEN k % 10 = 3 THEN '12.5d' WHEN k % 10 = 6 THEN '0x1p3' WHEN k % 11 = 0 THEN '91.5' ELSE CAST(k % 90 AS VARCHAR) || '.25' END AS lat,
      CAST(k % 180 AS VARCHAR) || '.5' AS lon FROM pl
    UNION ALL SELECT k, 2, CASE WHEN k % 5 <> 0 THEN b || ' yard' END, '-' || (k % 80), '-' || (k % 170) || '.75' FROM pl
    UNION ALL SELECT k, 3, n || ' gate', '12.5', CASE WHEN k % 13 <> 0 THEN '77.5' END FROM pl)"""


def _place_answers(spark, sf_dir) -> DataFrame:
    key = F.col("p_partkey")

    def entry(lat, lon, name):
        return F.struct(lat.alias("lat"), lon.alias("lon"), name.alias("display_name"))

    first = entry(
        F.when(key % 7 == 0, "north").when(key % 10 == 3, "12.5d").when(key % 10 == 6, "0x1p3").when(key % 11 == 0, "91.5").otherwise(F.concat(key % 90, F.lit(".25"))),
        F.concat(key % 180, F.lit(".5")),
        F.when(key % 9 == 0, "   ").otherwise(F.concat("p_name", F.lit(", "), "p_brand")),
    )
    second = entry(
        F.concat(F.lit("-"), key % 80),
        F.concat(F.lit("-"), key % 170, F.lit(".75")),
        F.when(key % 5 != 0, F.concat("p_brand", F.lit(" yard"))),
    )
    third = entry(F.lit("12.5"), F.when(key % 13 != 0, "77.5"), F.concat("p_name", F.lit(" gate")))
    return table(spark, sf_dir, "part").select(
        key.alias("search_id"),
        F.when(key % 17 == 0, "  ").otherwise(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("query"),
        F.when(key % 19 == 0, "[]").otherwise(F.to_json(F.array(first, second, third))).alias("response"),
    )


@query(
    "R8_clean_suggestions",
    f"WITH {_PLACES_SQL} SELECT k AS search_id, position, display_name, TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lon AS DOUBLE) AS lon "
    "FROM e WHERE k % 19 <> 0 AND TRY_CAST(lat AS DOUBLE) BETWEEN -90 AND 90 AND TRY_CAST(lon AS DOUBLE) BETWEEN -180 AND 180 "
    "AND trim(coalesce(display_name, '')) <> ''",
)
def clean_suggestions(spark, sf_dir):
    return P.clean_suggestions(_place_answers(spark, sf_dir).drop("query"))


@query(
    "R9_first_places",
    f"WITH {_PLACES_SQL}, q AS (SELECT k, CASE WHEN k % 17 = 0 THEN '' ELSE n END AS query, display_name, TRY_CAST(lat AS DOUBLE) AS lat, "
    "TRY_CAST(lon AS DOUBLE) AS lon FROM e JOIN pl USING (k) WHERE position = 1), "
    "j AS (SELECT *, CASE WHEN query = '' THEN 'EMPTY_QUERY' WHEN k % 19 = 0 THEN 'LOCATION_NOT_FOUND' "
    "WHEN lat IS NULL OR lon IS NULL THEN 'GEOCODING_SERVICE_ERROR' WHEN NOT coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, false) THEN 'INVALID_GEOCODING_RESPONSE' END AS error FROM q) "
    "SELECT k AS search_id, query, CASE WHEN error IS NULL THEN display_name END AS display_name, "
    "CASE WHEN error IS NULL THEN lat END AS lat, CASE WHEN error IS NULL THEN lon END AS lon, error FROM j",
)
def first_places(spark, sf_dir):
    return P.first_places(_place_answers(spark, sf_dir))


@query(
    "R10_one_answer_per_query",
    """WITH s AS (SELECT p_partkey AS search_id, CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN '  '
         WHEN p_partkey % 3 = 0 THEN ' ' || upper(p_name) WHEN p_partkey % 3 = 1 THEN p_name || '  '
         ELSE p_name END AS query, p_brand AS answer FROM part),
       q AS (SELECT *, lower(trim(query)) AS query_key FROM s)
       SELECT search_id, query, query_key, first_value(answer) OVER (PARTITION BY query_key ORDER BY search_id) AS answer,
         count(*) OVER (PARTITION BY query_key) AS searches, CAST(NULL AS VARCHAR) AS error FROM q WHERE query_key <> ''
       UNION ALL SELECT search_id, query, query_key, NULL, NULL, 'EMPTY_QUERY' FROM q WHERE coalesce(query_key, '') = ''""",
)
def one_answer_per_query(spark, sf_dir):
    key = F.col("p_partkey")
    searches = table(spark, sf_dir, "part").select(
        key.alias("search_id"),
        F.when(key % 11 == 0, F.lit(None).cast("string"))
        .when(key % 13 == 0, "  ")
        .when(key % 3 == 0, F.concat(F.lit(" "), F.upper("p_name")))
        .when(key % 3 == 1, F.concat("p_name", F.lit("  ")))
        .otherwise(F.col("p_name"))
        .alias("query"),
        F.col("p_brand").alias("answer"),
    )
    return P.one_answer_per_query(searches, "search_id")


# ------------------------------------------------------------------ name matching
_CORRIDORS = [
    (1, "outer-ring", ["Ring", "gear"]),
    (2, "hot-line", ["RED", "hot"]),
    (3, "plate-road", ["old - plate!", "cold"]),
    (4, "unused", ["zzz", "??"]),
]
_KEYWORDS_SQL = "kw AS (SELECT * FROM (VALUES {}) t(corridor_id, keyword))".format(
    ", ".join(
        f"('{corridor}', '{keyword}')"
        for corridor, keyword in [
            ("outer-ring", "ring"),
            ("outer-ring", "gear"),
            ("hot-line", "red"),
            ("hot-line", "hot"),
            ("plate-road", "old plate"),
            ("plate-road", "cold"),
            ("unused", "zzz"),
        ]
    )
)
_STEPS_SQL = (
    "st AS (SELECT p_partkey AS request_id, upper(p_name) || '.' AS road FROM part UNION ALL "
    "SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_type || ' / ' || p_name END FROM part), "
    "nm AS (SELECT request_id, trim(regexp_replace(lower(coalesce(road, '')), '[^a-z0-9]+', ' ', 'g')) AS road FROM st), "
    "mt AS (SELECT DISTINCT request_id, corridor_id FROM nm JOIN kw ON contains(road, keyword))"
)


def _corridor_table(spark) -> DataFrame:
    return unfold(
        spark.range(1),
        [
            {
                "position": F.lit(position),
                "corridor_id": F.lit(name),
                "keywords": F.array(*[F.lit(word) for word in words]),
            }
            for position, name, words in _CORRIDORS
        ],
    )


@query(
    "J4_corridors_on_route",
    f"WITH {_KEYWORDS_SQL}, {_STEPS_SQL} SELECT request_id, corridor_id, false AS is_fallback FROM mt UNION ALL "
    "SELECT p_partkey, 'outer-ring', true FROM part WHERE p_partkey NOT IN (SELECT request_id FROM mt)",
)
def corridors_on_route(spark, sf_dir):
    """Step names come from stored route documents; only the first leg counts."""
    def leg(*names):
        return F.struct(F.array(*[F.struct(name.alias("name")) for name in names]).alias("steps"))

    name = F.col("p_name")
    odd = F.when(F.col("p_partkey") % 4 != 0, F.concat("p_type", F.lit(" / "), name))
    routes = F.array(
        F.struct(
            F.array(leg(F.concat(F.upper(name), F.lit(".")), odd), leg(F.lit("zzz second leg"), F.lit("cold"))).alias("legs")
        )
    )
    document = F.to_json(F.struct(F.lit("Ok").alias("code"), routes.alias("routes")))
    documents = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("request_id"), document.alias("response"))
    parsed = documents.select("request_id", F.from_json("response", S.ROUTE_RESPONSE_SCHEMA).alias("d")).select(
        "request_id", F.col("d.routes").alias("routes")
    )
    return P.match_corridors(P.first_leg_roads(parsed, "request_id"), _corridor_table(spark))


_HINTS = ["Red Ring", "Redwood Gate", "Blue Bolt", "Small Street", "Hot Spring", "Old Plate", "Xylo Park"]


@query(
    "J5_merged_suggestions",
    f"""WITH s AS (SELECT split_part(p_name, ' ', 1) AS query, p_partkey AS position,
         CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) || ' (x), ' || p_type ELSE ' ' || p_name || ' (X), ' || p_type END AS display_name
         FROM part),
       m AS (SELECT query, lower(trim(display_name)) AS name_key, min(position) AS position, arg_min(display_name, position) AS display_name
         FROM s GROUP BY 1, 2),
       h AS (SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS no, hint FROM (SELECT unnest([{', '.join(sql_text(h) for h in _HINTS)}]) AS hint)),
       taken AS (SELECT query, name_key AS key FROM m UNION SELECT query,
         lower(trim(regexp_replace(split_part(display_name, ',', 1), '\\s*\\([^)]*\\)', '', 'g'))) FROM m)
       SELECT query, 'provider' AS source, position, display_name FROM m
       UNION ALL SELECT q.query, 'hint', no, hint || ', Bengaluru' FROM (SELECT DISTINCT query FROM m) q
         JOIN h ON starts_with(lower(hint), lower(q.query))
         WHERE NOT EXISTS (SELECT 1 FROM taken WHERE taken.query = q.query AND taken.key = lower(hint))""",
)
def merged_suggestions(spark, sf_dir):
    key, name = F.col("p_partkey"), F.col("p_name")
    results = table(spark, sf_dir, "part").select(
        F.split("p_name", " ")[0].alias("query"),
        key.alias("position"),
        F.when(key % 2 == 0, F.concat(F.upper(name), F.lit(" (x), "), "p_type"))
        .otherwise(F.concat(F.lit(" "), name, F.lit(" (X), "), "p_type"))
        .alias("display_name"),
    )
    return P.merge_suggestions(results, _HINTS)
