"""Place search results, name matching and suggestion lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadgrain import schemas as S
from roadgrain.functions.derive import decimal_number, in_range
from roadgrain.functions.text import is_meaningful_query, normal_name, primary_place_name, query_key, strip
from roadgrain.operators.rows import unfold


def clean_suggestions(answers: DataFrame, column: str = "response") -> DataFrame:
    """Usable entries of stored place-search answers, in their order.

    Entries without numeric in-range coordinates or with a blank name are skipped.
    """
    others = [name for name in answers.columns if name != column]
    parsed = F.from_json(column, S.PLACE_RESULTS_SCHEMA)
    entries = answers.select(*others, F.posexplode_outer(parsed).alias("pos", "entry")).where("entry IS NOT NULL")
    located = entries.select(
        *others,
        (F.col("pos") + 1).alias("position"),
        F.col("entry.display_name").alias("display_name"),
        decimal_number(F.col("entry.lat")).alias("lat"),
        decimal_number(F.col("entry.lon")).alias("lon"),
    )
    return located.where(
        in_range(F.col("lat"), -90, 90)
        & in_range(F.col("lon"), -180, 180)
        & (F.coalesce(strip(F.col("display_name")), F.lit("")) != "")
    )


def first_places(answers: DataFrame, query: str = "query", column: str = "response") -> DataFrame:
    """First result per search; the name defaults to the query text.

    ``error`` is set for a blank query, an empty answer, unreadable coordinates
    (``GEOCODING_SERVICE_ERROR``) or coordinates out of range (``INVALID_GEOCODING_RESPONSE``).
    """
    others = [name for name in answers.columns if name not in (query, column)]
    clean = strip(F.col(query))
    entry = F.try_element_at(F.from_json(column, S.PLACE_RESULTS_SCHEMA), F.lit(1))
    found = answers.select(*others, clean.alias("query"), entry.alias("entry")).select(
        *others,
        "query",
        F.col("entry").isNotNull().alias("found"),
        F.coalesce("entry.display_name", "query").alias("display_name"),
        decimal_number(F.col("entry.lat")).alias("lat"),
        decimal_number(F.col("entry.lon")).alias("lon"),
    )
    error = (
        F.when(F.coalesce("query", F.lit("")) == "", "EMPTY_QUERY")
        .when(~F.col("found"), "LOCATION_NOT_FOUND")
        .when(F.col("lat").isNull() | F.col("lon").isNull(), "GEOCODING_SERVICE_ERROR")
        .when(
            ~(in_range(F.col("lat"), -90, 90) & in_range(F.col("lon"), -180, 180)), "INVALID_GEOCODING_RESPONSE"
        )
    )
    checked = found.withColumn("error", error)
    good = F.col("error").isNull()
    return checked.select(
        *others,
        "query",
        F.when(good, F.col("display_name")).alias("display_name"),
        F.when(good, F.col("lat")).alias("lat"),
        F.when(good, F.col("lon")).alias("lon"),
        "error",
    )


def one_answer_per_query(
    searches: DataFrame, order: str, query: str = "query", answer: str = "answer", salts: int = 16
) -> DataFrame:
    """Give every search the answer of the earliest search with the same query key.

    A null or blank query has no answer but the error ``EMPTY_QUERY``. The earliest place of a
    key is a hash aggregate; its answer is looked up by (key, place). Searches meet the
    one row of their key by key and a salt, so a very frequent query is spread over ``salts`` tasks.
    """
    keyed = searches.withColumn("query_key", query_key(F.col(query))).withColumn(
        "_salt", F.pmod(F.xxhash64(order), F.lit(salts)).cast("int")
    )
    asked = keyed.where("query_key <> ''")
    firsts = asked.groupBy("query_key").agg(F.min(order).alias(order), F.count(F.lit(1)).alias("searches"))
    answers = (
        firsts.join(asked.select("query_key", order, F.col(answer).alias("_answer")), ["query_key", order])
        .dropDuplicates(["query_key"])
        .select("query_key", "searches", "_answer", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    )
    blank = F.coalesce(F.col("query_key") == "", F.lit(True))
    return keyed.join(answers, ["query_key", "_salt"], "left").select(
        order,
        query,
        "query_key",
        F.col("_answer").alias(answer),
        "searches",
        F.when(blank, "EMPTY_QUERY").alias("error"),
    )


def match_corridors(roads: DataFrame, corridors: DataFrame, request: str = "request_id") -> DataFrame:
    """Corridors whose keyword occurs inside a road name of the request.

    ``roads`` is (request, name); ``corridors`` is (position, corridor_id, keywords
    array). Rows (request, corridor_id, is_fallback): a request with no match gets the
    first corridor, marked as fallback, because it is not evidence.

    Containment is turned into an equi-join on one signature length, that of the shortest keyword:
    each distinct name gives its substrings of that length, which meet the keywords that begin
    with them; then the whole keyword is looked for. Neither side is compared all against all.
    """
    named = roads.select(request, normal_name(F.col("name")).alias("road"))
    keywords = (
        corridors.select("position", "corridor_id", F.explode("keywords").alias("k"))
        .select("position", "corridor_id", normal_name(F.col("k")).alias("keyword"))
        .where("keyword <> ''")
    )
    n = keywords.agg(F.min(F.length("keyword"))).scalar()
    signed = keywords.select("corridor_id", "keyword", F.substring("keyword", F.lit(1), n).alias("signature"))
    pieces = (
        named.where("road <> ''")
        .select("road")
        .distinct()
        .where(F.length("road") >= n)
        .select("road", F.explode(F.sequence(F.lit(1), F.length("road") - n + 1)).alias("start"))
        .select("road", F.substring("road", F.col("start"), n).alias("signature"))
    )
    met = pieces.join(signed, "signature").where(F.contains("road", "keyword"))
    road_matches = met.groupBy("road", "corridor_id").agg(F.count(F.lit(1)).alias("places")).drop("places")
    first = corridors.agg(F.min_by("corridor_id", "position")).scalar()
    # The filters are on an aggregate and stay above the group-by, so both uses of
    # ``cells`` keep the same shuffle, which is then done once.
    cells = (
        named.join(road_matches, "road", "left")
        .groupBy(request, "corridor_id")
        .agg(F.count("corridor_id").alias("hits"))
    )
    matched = cells.where("hits > 0").select(request, "corridor_id", F.lit(False).alias("is_fallback"))
    unmatched = cells.groupBy(request).agg(F.sum("hits").alias("hits")).where("hits = 0")
    fallback = unmatched.select(request, first.alias("corridor_id"), F.lit(True).alias("is_fallback"))
    return matched.unionByName(fallback.where("corridor_id IS NOT NULL"))


def first_leg_roads(parsed_documents: DataFrame, request: str, routes: str = "routes") -> DataFrame:
    """Road names (request, name) from the steps of each route's first leg."""
    first_leg = F.transform(F.col(routes), lambda r: F.try_element_at(r.getField("legs"), F.lit(1)).getField("steps"))
    return parsed_documents.select(
        request, F.explode_outer(F.flatten(F.filter(first_leg, lambda s: s.isNotNull()))).alias("step")
    ).select(request, F.coalesce("step.name", F.lit("")).alias("name"))


def merge_suggestions(
    results: DataFrame, hints: list[str], queries: DataFrame | None = None, suffix: str = S.HINT_SUFFIX
) -> DataFrame:
    """Suggestion list per query: provider results, then fixed hints that start with the query.

    ``results`` is (query, position, display_name). Equal names (trimmed, any case) keep
    the earliest. A hint is left out when its name is already there as a full or a
    primary name. ``queries`` adds queries that have no result. Hints are cut into their
    prefixes, so matching them is an equi-join on the lower-case query.
    """
    key = F.lower(strip(F.col("display_name")))
    merged = (
        results.groupBy("query", key.alias("name_key"))
        .agg(F.min(F.struct("position", "display_name")).alias("first"))
        .select("query", "name_key", "first.position", "first.display_name")
    )
    asked = merged.select("query") if queries is None else merged.select("query").union(queries.select("query"))
    hint_table = unfold(
        results.sparkSession.range(1), [{"hint_no": F.lit(i), "hint": F.lit(name)} for i, name in enumerate(hints)]
    )
    prefixes = hint_table.select(
        "hint_no", "hint", F.explode(F.sequence(F.lit(1), F.length("hint"))).alias("n")
    ).select("hint_no", "hint", F.lower(F.left("hint", F.col("n"))).alias("prefix"))
    taken = merged.select("query", F.explode(F.array("name_key", primary_place_name(F.col("display_name")))).alias("k"))
    added = (
        asked.distinct()
        .join(prefixes, F.lower("query") == F.col("prefix"))
        .withColumn("k", F.lower("hint"))
        .join(taken, ["query", "k"], "left_anti")
        .select(
            "query",
            F.lit("hint").alias("source"),
            F.col("hint_no").cast("bigint").alias("position"),
            F.concat("hint", F.lit(suffix)).alias("display_name"),
        )
    )
    provided = merged.select(
        "query", F.lit("provider").alias("source"), F.col("position").cast("bigint").alias("position"), "display_name"
    )
    return provided.unionByName(added)


def meaningful(queries: DataFrame, column: str = "query") -> DataFrame:
    return queries.where(is_meaningful_query(F.col(column)))
