"""One answer for every stored route request: resolved end points and ranked routes, or the first error.

Requests meet stored place answers by query key and stored route responses by request. Each step
that can fail gives a struct (code, message) or null, and the first of them decides. Only the
lookups shuffle; a place that very many requests name is spread over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadgrain import schemas as S
from roadgrain.functions.derive import in_range, provider_error, request_status
from roadgrain.functions.text import query_key, strip
from roadgrain.operators.places import first_places
from roadgrain.operators.routes import parse_responses, rank_routes, recommend, validate_routes
from roadgrain.operators.rows import look_up
from roadgrain.operators.shape import coordinate_problem, endpoint_problem

ENDS = ("origin", "destination")


def _failure(code: Column | str, message: Column | str | None = None) -> Column:
    """struct(code, message); the message defaults to the one that belongs to the code."""
    code = F.lit(code) if isinstance(code, str) else code
    if message is None:
        message = F.lit(None).cast("string")
        for name, text in S.REQUEST_MESSAGE.items():
            message = F.when(code == name, text).otherwise(message)
    message = F.lit(message) if isinstance(message, str) else message
    return F.struct(code.alias("code"), message.alias("message"))


def known_places(places: DataFrame, order: str = "place_id") -> DataFrame:
    """One row for each query key of stored place answers (order, query, response, message): the earliest.

    Columns query_key and place, a struct (display_name, lat, lon, failure). A stored message of the
    provider counts before the response. Blank and null queries name no place.
    """
    read = first_places(places.select(order, "query", "response", "message"))
    said = provider_error(F.col("message"), F.lit("geocoding"))["error_code"]
    unresolved = F.concat(
        F.lit("Location '"), "query", F.lit("' could not be resolved by OpenStreetMap Nominatim.")
    )
    failure = (
        F.when(F.col("message").isNotNull(), _failure(said, F.col("message")))
        .when(F.col("error") == "LOCATION_NOT_FOUND", _failure(F.col("error"), unresolved))
        .when(F.col("error") == "GEOCODING_SERVICE_ERROR", _failure(F.col("error"), "Failed to parse geocoding response."))
        .when(F.col("error").isNotNull(), _failure(F.col("error")))
    )
    place = F.struct(order, "display_name", "lat", "lon", failure.alias("failure"))
    keyed = read.select(query_key(F.col("query")).alias("query_key"), place.alias("place"))
    return keyed.where("query_key <> ''").groupBy("query_key").agg(F.min("place").alias("place"))


def _pair_failure(latitude: Column, longitude: Column, code: str) -> Column:
    """Half a pair is a bad request; a whole one that is no place counts as a bad place answer."""
    problem = coordinate_problem(latitude, longitude)
    return F.when(problem == "INCOMPLETE", _failure(code))


def _end(name: str) -> tuple[Column, Column]:
    """What a request's end point resolves to, and why it doesn't."""
    latitude, longitude, place = F.col(f"{name}_lat"), F.col(f"{name}_lon"), F.col(f"{name}_place")
    text = strip(F.col(name))
    given = latitude.isNotNull() & longitude.isNotNull()
    found = F.struct(
        text.alias("query"),
        F.when(given, text).otherwise(place["display_name"]).alias("display_name"),
        F.when(given, latitude).otherwise(place["lat"]).alias("latitude"),
        F.when(given, longitude).otherwise(place["lon"]).alias("longitude"),
    )
    usable = in_range(latitude, -90, 90) & in_range(longitude, -180, 180)
    failure = (
        F.when(given, F.when(~usable, _failure("INVALID_GEOCODING_RESPONSE")))
        .when(place.isNull(), _failure("GEOCODING_SERVICE_ERROR", "No answer is stored for this place."))
        .otherwise(place["failure"])
    )
    return found, failure


def _routing_failure() -> Column:
    """Why a stored route response, parsed and validated beside its text and message, gives no routes."""
    text, message, code, problem = (F.col(c) for c in ("route_text", "route_message", "code", "problem"))
    document = F.try_parse_json(text)
    listed = F.try_variant_get(document, "$.routes", "variant")
    kind = F.schema_of_variant(listed)
    nothing = listed.isNull() | kind.isin("VOID", "OBJECT<>") | F.try_variant_get(document, "$.routes", "string").isin("", "0", "false")
    not_ok = ~F.coalesce(code == "Ok", F.lit(False))
    told = F.concat(
        F.lit("OSRM routing response: "),
        F.coalesce(code, F.lit("None")),
        F.lit(" - "),
        F.coalesce(F.try_variant_get(document, "$.message", "string"), F.lit("No route found.")),
    )

    def said(words: Column) -> Column:
        return _failure(provider_error(words, F.lit("routing"))["error_code"], words)

    wording = F.lit(None).cast("string")
    for name, words in S.ROUTING_MESSAGE.items():
        wording = F.when(problem == name, words).otherwise(wording)
    return (
        F.when(message.isNotNull(), said(message))
        .when(text.isNull(), _failure("OSRM_SERVICE_ERROR", "No answer is stored for this request."))
        .when(not_ok & document.isNull(), _failure("OSRM_SERVICE_ERROR", "Failed to parse OSRM JSON response."))
        .when(
            not_ok & ~F.schema_of_variant(document).startswith("OBJECT"),
            _failure("OSRM_SERVICE_ERROR", "Unexpected routing failure."),
        )
        .when(not_ok, said(told))
        .when((problem == "ROUTE_NOT_FOUND") | (problem == "MISSING_ROUTES") & nothing, _failure("ROUTE_NOT_FOUND"))
        .when(problem.isNotNull(), _failure("INVALID_ROUTING_RESPONSE", wording))
    )


def answer_requests(requests: DataFrame, places: DataFrame, responses: DataFrame, salts: int = 16) -> DataFrame:
    """One row for each request.

    ``requests`` has request_id, origin, destination and origin_lat, origin_lon, destination_lat,
    destination_lon (given coordinates take the place of a search); ``places`` is (place_id, query,
    response, message) and ``responses`` (request_id, response, message), one row per request.

    Columns: request_id, status, error_code, error_message; origin and destination as structs
    (query, display_name, latitude, longitude), routes as an array of options,
    recommended_route_id, alternatives_available and recommendation_rationale, all null if there
    is an error. Order of errors: half a coordinate pair, empty or equal end points, the origin's
    place, the destination's place, the routing provider, its routes. Nulls count as absent.
    """
    known = known_places(places)
    rows = requests
    for end in ENDS:
        keyed = rows.withColumn("query_key", F.coalesce(query_key(F.col(end)), F.lit("")))
        rows = look_up(keyed, known, "query_key", "request_id", salts).withColumnRenamed("place", f"{end}_place").drop("query_key")
    stored = responses.select("request_id", F.col("response").alias("route_text"), F.col("message").alias("route_message"))
    joined = rows.join(stored, "request_id", "left").withColumn("response", F.col("route_text"))
    read = recommend(rank_routes(validate_routes(parse_responses(joined))))
    (start, start_failure), (goal, goal_failure) = (_end(end) for end in ENDS)
    pairs = {end: (F.col(f"{end}_lat"), F.col(f"{end}_lon")) for end in ENDS}
    ends = endpoint_problem(F.col("origin"), F.col("destination"), pairs["origin"], pairs["destination"])
    failure = F.coalesce(
        _pair_failure(*pairs["origin"], "INVALID_ORIGIN_COORDINATES"),
        _pair_failure(*pairs["destination"], "INVALID_DESTINATION_COORDINATES"),
        F.when(ends.isNotNull(), _failure(ends)),
        start_failure,
        goal_failure,
        _routing_failure(),
    )
    option = F.transform(
        "routes",
        lambda r: F.struct(
            F.concat(F.lit("route_"), r["route_index"].cast("string")).alias("id"),
            *[r[name].alias(name) for name in ("summary", "status", "distance_km", "duration_minutes", "duration_formatted")],
            F.lit(S.DURATION_BASIS).alias("duration_basis"),
            r["coordinates"].alias("geometry"),
            r["recommendation_reason"].alias("recommendation_reason"),
        ),
    )
    good = F.col("failure").isNull()
    answers = {
        "origin": start,
        "destination": goal,
        "routes": option,
        "recommended_route_id": F.col("recommended_route_id"),
        "alternatives_available": F.col("alternatives_available"),
        "recommendation_rationale": F.col("recommendation_rationale"),
    }
    return read.withColumn("failure", failure).select(
        "request_id",
        request_status(F.col("failure.code")).alias("status"),
        F.col("failure.code").alias("error_code"),
        F.col("failure.message").alias("error_message"),
        *[F.when(good, value).alias(name) for name, value in answers.items()],
    )
