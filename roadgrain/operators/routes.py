"""Candidate routes of stored provider responses.

A response is one row holding all its candidates in an array, so parsing, ranking and
wording are array functions on that row: nothing here shuffles, and no group of
requests can become hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadgrain import schemas as S
from roadgrain.functions.derive import (
    duration_text,
    in_range,
    is_finite,
    json_number,
    kilometres,
    minutes_2dp,
    whole_minutes,
)
from roadgrain.functions.text import strip

_EMPTY_POINTS = "array<struct<lat:double,lon:double>>"


def _points(coordinates: Column) -> Column:
    """[lon, lat] pairs to (lat, lon) structs; points with fewer than two numbers are dropped."""
    pairs = F.filter(coordinates, lambda p: F.size(p) >= 2)
    points = F.transform(pairs, lambda p: F.struct(p.getItem(1).alias("lat"), p.getItem(0).alias("lon")))
    return F.coalesce(points, F.array().cast(_EMPTY_POINTS))


def _numbers(route: Column, position: Column) -> list[Column]:
    """What a candidate says: index, summary, metres and seconds. Unreadable numbers are null, absent ones 0."""
    index = position + F.lit(1)
    named = strip(F.try_element_at(route.getField("legs"), F.lit(1)).getField("summary"))
    summary = F.when(F.coalesce(named, F.lit("")) != "", named).otherwise(F.concat(F.lit("Route "), index))
    given = route.isNotNull()
    return [
        index.alias("route_index"),
        summary.alias("summary"),
        F.when(given, json_number(route.getField("distance"))).alias("distance_meters"),
        F.when(given, json_number(route.getField("duration"))).alias("duration_seconds"),
    ]


def _worded(read: Column) -> list[Column]:
    """The columns of a candidate that was read, with kilometres and the text of its duration."""
    field = read.getField
    seconds = field("duration_seconds")
    return [
        field("route_index").alias("route_index"),
        field("summary").alias("summary"),
        field("distance_meters").alias("distance_meters"),
        kilometres(field("distance_meters")).alias("distance_km"),
        seconds.alias("duration_seconds"),
        F.when(is_finite(seconds), duration_text(seconds)).alias("duration_formatted"),
    ]


def _geometry(route: Column) -> Column:
    return _points(route.getField("geometry").getField("coordinates")).alias("coordinates")


def parse_responses(responses: DataFrame, column: str = "response") -> DataFrame:
    """Parse response JSON into ``code``, ``response_problem`` and an array ``routes``.

    A number that is null or no number is null in its candidate, which then can't be recommended;
    an absent number counts as 0.
    """
    document = F.from_json(F.col(column), S.ROUTE_RESPONSE_SCHEMA)
    others = [name for name in responses.columns if name != column]
    return responses.select(*others, document.alias("document"), F.col(column).alias("text")).select(
        *others,
        F.col("document.code").alias("code"),
        response_problem(F.col("document"), F.col("text")).alias("response_problem"),
        # read first, then worded: the inner result is bound, so that no number is parsed twice
        F.transform(
            F.transform(
                F.coalesce("document.routes", F.array().cast(S.ROUTES_TYPE)),
                lambda r, i: F.struct(*_numbers(r, i), _geometry(r)),
            ),
            lambda c: F.struct(*_worded(c), c.getField("coordinates").alias("coordinates")),
        ).alias("routes"),
    )


def candidate_rows(responses: DataFrame, column: str = "response") -> DataFrame:
    """One row per candidate of every response, parsed but not ranked.

    The candidates are exploded before their fields are derived, so the derivation is
    compiled with the rest of the stage instead of being interpreted per array element.
    """
    others = [name for name in responses.columns if name != column]
    # The outer form, because for the inner one Spark adds a size filter that parses the text again.
    routes = F.from_json(F.col(column), S.ROUTE_RESPONSE_SCHEMA).getField("routes")
    raw = responses.select(*others, F.posexplode_outer(routes).alias("pos", "raw")).where("pos IS NOT NULL")
    read = raw.select(*others, F.struct(*_numbers(F.col("raw"), F.col("pos"))).alias("c"), _geometry(F.col("raw")))
    return read.select(*others, *_worded(F.col("c")), "coordinates")


def response_problem(document: Column, text: Column) -> Column:
    """Why a parsed response is unusable, null when it is fine.

    A list of routes that doesn't fit the schema is UNREADABLE_ROUTE; the text is only looked at again to tell that.
    """
    routes = document.getField("routes")
    listed = F.try_variant_get(F.try_parse_json(text), "$.routes", "array<variant>").isNotNull()
    return (
        F.when(document.isNull() | ~F.coalesce(document.getField("code") == "Ok", F.lit(False)), "INVALID_RESPONSE")
        .when(routes.isNull() & listed, "UNREADABLE_ROUTE")
        .when(routes.isNull(), "MISSING_ROUTES")
        .when(F.size(routes) == 0, "ROUTE_NOT_FOUND")
    )


def route_problem(route: Column) -> Column:
    """First broken rule of a candidate: distance, duration, number of points, coordinates."""

    def usable(number: Column) -> Column:
        return is_finite(number) & (number >= 0)

    points = route.getField("coordinates")
    return (
        F.when(~usable(route.getField("distance_km")), "INVALID_DISTANCE")
        .when(~usable(route.getField("duration_seconds")), "INVALID_DURATION")
        .when(F.size(points) < 2, "TOO_FEW_POINTS")
        .when(
            ~F.forall(
                points, lambda p: in_range(p.getField("lat"), -90, 90) & in_range(p.getField("lon"), -180, 180)
            ),
            "INVALID_COORDINATES",
        )
    )


def validate_routes(parsed: DataFrame) -> DataFrame:
    """Add ``problem``: the response's problem, then an unreadable number of any candidate, then the first broken rule."""
    found = F.filter(F.transform("routes", route_problem), lambda p: p.isNotNull())
    unreadable = F.when(F.exists("routes", _is_unreadable), "UNREADABLE_ROUTE")
    return parsed.withColumn("problem", F.coalesce("response_problem", unreadable, F.try_element_at(found, F.lit(1))))


def _is_unreadable(route: Column) -> Column:
    return route.getField("distance_meters").isNull() | route.getField("duration_seconds").isNull()


def _in_rank_order(routes: Column) -> Column:
    """Sort by whole minutes started, then metres, then input order; unreadable candidates come last."""
    keyed = F.transform(
        routes,
        lambda r: F.struct(
            _is_unreadable(r).alias("unreadable"),
            F.floor(r.getField("duration_seconds") / 60.0).alias("bucket"),
            r.getField("distance_meters").alias("metres"),
            r.getField("route_index").alias("position"),
            r.alias("route"),
        ),
    )
    return F.transform(F.sort_array(keyed), lambda k: k.getField("route"))


def _status(size: Column, is_first: Column) -> Column:
    recommended, alternative, only = S.ROUTE_STATUS
    return F.when(size == 1, only).when(is_first, recommended).otherwise(alternative)


def _reason(route: Column, is_first: Column, first: Column, second: Column, size: Column) -> Column:
    """Why a worded candidate has its rank, given the two best ones (seconds, kilometres and summary of them)."""
    text, field = S.ROUTE_TEXT, route.getField
    minutes_saved = whole_minutes(second.getField("duration_seconds") - first.getField("duration_seconds"))
    return (
        F.when(
            size == 1,
            F.format_string(text["only_reason"], field("summary"), field("duration_formatted"), field("distance_km")),
        )
        .when(
            is_first & (minutes_saved > 0),
            F.format_string(text["faster_reason"], minutes_saved, second.getField("summary")),
        )
        .when(is_first, F.format_string(text["shorter_reason"], field("duration_formatted"), field("distance_km")))
        .otherwise(
            F.format_string(
                text["alternative_reason"],
                field("summary"),
                whole_minutes(field("duration_seconds") - first.getField("duration_seconds")),
                F.bround(field("distance_km") - first.getField("distance_km"), 1),
            )
        )
    )


def _with_verdict(route: Column, position: Column, first: Column, second: Column, size: Column) -> Column:
    """Add rank, status and reason to a candidate, given the two best ones."""
    field, is_first = route.getField, position == 0
    fields = ["route_index", "summary", "distance_meters", "distance_km", "duration_seconds", "duration_formatted"]
    return F.struct(
        (position + 1).alias("rank"),
        *[field(name).alias(name) for name in fields],
        minutes_2dp(field("duration_seconds")).alias("duration_minutes"),
        _status(size, is_first).alias("status"),
        _reason(route, is_first, first, second, size).alias("recommendation_reason"),
        field("coordinates").alias("coordinates"),
    )


def rank_routes(parsed: DataFrame) -> DataFrame:
    """Replace ``routes`` by the ranked candidates with status and reason.

    The sorted array is bound as a lambda variable, so it is sorted once per response
    and not again for every candidate that is compared with the best two.
    """

    def verdicts(ordered: Column) -> Column:
        first, second = (F.try_element_at(ordered, F.lit(i)) for i in (1, 2))
        return F.transform(ordered, lambda r, i: _with_verdict(r, i, first, second, F.size(ordered)))

    return parsed.withColumn("routes", F.transform(F.array(_in_rank_order(F.col("routes"))), verdicts)[0])


def recommend(ranked: DataFrame) -> DataFrame:
    """Add the request-level answer: recommended id, selected id, alternatives flag, rationale."""
    text, routes = S.ROUTE_TEXT, F.col("routes")
    first, second = (F.try_element_at(routes, F.lit(i)) for i in (1, 2))
    a, b = first.getField, second.getField
    size = F.size(routes)
    saved = whole_minutes(b("duration_seconds") - a("duration_seconds"))
    first_id = F.concat(F.lit("route_"), a("route_index").cast("string"))
    rationale = (
        F.when(size == 0, text["none_rationale"])
        .when(
            size == 1,
            F.format_string(text["only_rationale"], a("summary"), a("duration_formatted"), a("distance_km")),
        )
        .when(
            saved > 0,
            F.format_string(
                text["faster_rationale"],
                a("summary"),
                a("duration_formatted"),
                a("distance_km"),
                saved,
                b("summary"),
                b("duration_formatted"),
            ),
        )
        .otherwise(
            F.format_string(
                text["shorter_rationale"], a("summary"), a("distance_km"), b("distance_km"), b("summary")
            )
        )
    )
    return ranked.withColumns(
        {
            "recommended_route_id": F.when(size > 1, first_id),
            "selected_route_id": F.when(size > 0, first_id),
            "alternatives_available": size > 1,
            "recommendation_rationale": rationale,
        }
    )


def ranked_rows(responses: DataFrame, *keys: str, column: str = "response") -> DataFrame:
    """One row per ranked candidate of every stored response, without its geometry.

    Only what is read is sorted inside the array; the rows then carry the two best candidates'
    few values along, and kilometres, texts and reasons are derived after the array is unfolded:
    compiled with the stage, without an exchange, and pruned if nobody asks for them.
    """
    routes = F.from_json(F.col(column), S.ROUTE_RESPONSE_SCHEMA).getField("routes")
    read = F.transform(routes, lambda r, i: F.struct(*_numbers(r, i)))
    ordered = responses.select(*keys, _in_rank_order(read).alias("ordered"))
    best, second = (F.try_element_at("ordered", F.lit(i)) for i in (1, 2))
    # The outer form keeps Spark from adding a size filter that would parse and sort everything twice.
    rows = ordered.select(
        *keys,
        F.size("ordered").alias("size"),
        best.alias("best"),
        second.alias("second"),
        F.posexplode_outer("ordered").alias("pos", "read"),
    ).where("read IS NOT NULL")
    worded = rows.select(
        *keys,
        "size",
        "pos",
        F.struct(*_worded(F.col("read"))).alias("route"),
        F.struct("best.duration_seconds", kilometres(F.col("best.distance_meters")).alias("distance_km")).alias("best"),
        F.struct("second.duration_seconds", "second.summary").alias("second"),
    )
    is_first = F.col("pos") == 0
    return worded.select(
        *keys,
        (F.col("pos") + 1).alias("rank"),
        "route.*",
        minutes_2dp(F.col("route.duration_seconds")).alias("duration_minutes"),
        _status(F.col("size"), is_first).alias("status"),
        _reason(F.col("route"), is_first, F.col("best"), F.col("second"), F.col("size")).alias("recommendation_reason"),
    )


def route_bounds(ranked: DataFrame, origin: Column, destination: Column, *keys: str) -> DataFrame:
    """Bounding box over the end points and all candidate points, and the end points' centre.

    ``origin`` and ``destination`` are structs (lat, lon).
    """
    points = F.concat(F.array(origin, destination), F.flatten(F.transform("routes", lambda r: r.getField("coordinates"))))
    located = ranked.select(*keys, origin.alias("a"), destination.alias("b"), points.alias("points"))
    lats = F.transform("points", lambda p: p.getField("lat"))
    lons = F.transform("points", lambda p: p.getField("lon"))
    return located.select(
        *keys,
        F.array_min(lats).alias("min_lat"),
        F.array_max(lats).alias("max_lat"),
        F.array_min(lons).alias("min_lon"),
        F.array_max(lons).alias("max_lon"),
        ((F.col("a.lat") + F.col("b.lat")) / 2.0).alias("center_lat"),
        ((F.col("a.lon") + F.col("b.lon")) / 2.0).alias("center_lon"),
    )
