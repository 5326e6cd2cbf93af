"""Traffic-shaped views over the given tables.

One order is one traffic observation: the customer's nation and region are the road
and the area, the price is the congestion level. See ``observations``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadgrain import schemas as S
from roadgrain.functions.derive import corridor_name, day_type, threshold_class
from roadgrain.operators.calendar import integrate_calendar
from roadgrain.operators.rows import unfold

# Month, day, name, festival, holiday of the yearly calendar.
YEARLY_CALENDAR = [
    (1, 15, "Makara Sankranti", True, True),
    (1, 26, "Republic Day", False, True),
    (3, 22, "Ugadi Festival", True, True),
    (5, 1, "May Day", False, True),
    (8, 15, "Independence Day", False, True),
    (10, 2, "Gandhi Jayanthi", False, True),
    (10, 24, "Vijayadasami", True, True),
    (11, 1, "Kannada Rajyothsava", True, True),
]
# Market segment to weather.
WEATHER_OF_SEGMENT = {
    "BUILDING": "Clear",
    "MACHINERY": "Overcast",
    "AUTOMOBILE": "Fog",
    "HOUSEHOLD": "Rain",
    "FURNITURE": "Windy",
}

# The given tables that are read.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Joined one after the other, so that the size of every joined side is that of its file and
# not an estimate of a join. Only the customers can be too large to broadcast.
_DIMENSION_JOINS = [
    ("customer", "o_custkey", "c_custkey"),
    ("nation", "c_nationkey", "n_nationkey"),
    ("region", "n_regionkey", "r_regionkey"),
]
# How many of these joins a column needs.
_DIMENSION_DEPTH = {"weather": 1, "average_speed": 1, "road_intersection": 2, "area": 3, "corridor": 3}
_CALENDAR_COLUMNS = {"festival_flag", "festival_name", "holiday_flag"}
OBSERVATION_COLUMNS = ["obs_id", *S.INTEGRATED_COLUMNS]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read with its known schema so that no footer is opened to infer it."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date dimension: the yearly template over the years of the facts' first to last date, found in one look."""
    day = F.col("o_orderdate")
    limits = table(spark, sf_dir, "orders").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    years = limits.select(F.explode(F.sequence(F.year("first"), F.year("last"))).alias("y"))
    names = ("m", "d", "festival_name", "festival_flag", "holiday_flag")
    template = unfold(years, [{n: F.lit(v) for n, v in zip(names, row)} for row in YEARLY_CALENDAR], "y")
    return template.select(
        F.make_date("y", "m", "d").alias("date"),
        "festival_name",
        "festival_flag",
        "holiday_flag",
        F.concat(F.lit("yearly template "), "y").alias("source"),
    )


def _order_expressions() -> dict[str, Column]:
    day = F.col("o_orderdate").cast("date")
    level = F.col("o_totalprice") / 5000.0
    weekday = F.dayofweek(day)
    return {
        "obs_id": F.col("o_orderkey"),
        "date": day,
        "traffic_volume": F.col("o_totalprice") * (F.lit(0.9) + (F.col("o_custkey") % 5) * F.lit(0.05)),
        "travel_time_index": F.lit(1.0) + (F.col("o_custkey") % 100) / F.lit(200.0),
        "congestion_level": level,
        "congestion_class": threshold_class(level),
        "roadwork": F.when(F.col("o_orderpriority") == "1-URGENT", "Yes").otherwise("No"),
        "day_of_week": weekday,
        "day_type": day_type(weekday),
    }


def _dimension_expressions() -> dict[str, Column]:
    weather = F.lit(None).cast("string")
    for segment, name in WEATHER_OF_SEGMENT.items():
        weather = F.when(F.col("c_mktsegment") == segment, name).otherwise(weather)
    return {
        "area": F.col("r_name"),
        "road_intersection": F.col("n_name"),
        "corridor": corridor_name(F.col("r_name"), F.col("n_name")),
        "average_speed": F.lit(20.0) + (F.col("c_acctbal") + 1000) / 160.0,
        "weather": weather,
    }


def observations(
    spark: SparkSession,
    sf_dir: str,
    *columns: str,
    since: str | None = None,
    before: str | None = None,
) -> DataFrame:
    """Observations with the integrated columns and a unique ``obs_id``.

    All joins are left joins on unique keys, so a join no requested column needs is
    left out without changing the rows. No side is hinted: Spark broadcasts a table
    whose file size is under its threshold and sorts otherwise. ``since`` and
    ``before`` bound the date on the stored column, so that row groups are skipped.
    """
    wanted = list(columns) or OBSERVATION_COLUMNS
    orders = table(spark, sf_dir, "orders")
    if since:
        orders = orders.where(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
    if before:
        orders = orders.where(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz"))

    expressions = _order_expressions()
    depth = max(_DIMENSION_DEPTH.get(name, 0) for name in wanted)
    for name, left_key, right_key in _DIMENSION_JOINS[:depth]:
        orders = orders.join(table(spark, sf_dir, name), F.col(left_key) == F.col(right_key), "left")
    of_dimensions = _dimension_expressions()
    expressions |= {name: of_dimensions[name] for name in wanted if name in of_dimensions}

    needs_calendar = bool(_CALENDAR_COLUMNS & set(wanted))
    kept = [name for name in expressions if name in wanted or (needs_calendar and name == "date")]
    facts = orders.select(*[expressions[name].alias(name) for name in kept])
    if needs_calendar:
        facts = integrate_calendar(facts, calendar(spark, sf_dir))
    return facts.select(*wanted)


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same observations under the 16 raw column names, plus ``obs_id``."""
    back = {standard: raw for raw, standard in S.RAW_TO_STANDARD.items()}
    base = observations(spark, sf_dir, "obs_id", *back)
    extra = {
        "Road Capacity Utilization": (F.col("obs_id") % 100).cast("double"),
        "Incident Reports": (F.col("obs_id") % 7).cast("double"),
        "Environmental Impact": (F.col("obs_id") % 150).cast("double"),
        "Public Transport Usage": (F.col("obs_id") % 80).cast("double"),
        "Traffic Signal Compliance": (F.col("obs_id") % 95).cast("double"),
        "Parking Usage": (F.col("obs_id") % 60).cast("double"),
        "Pedestrian and Cyclist Count": (F.col("obs_id") % 200).cast("double"),
    }
    return base.select(
        "obs_id",
        *[
            (F.col(S.RAW_TO_STANDARD[name]) if name in S.RAW_TO_STANDARD else extra[name]).alias(name)
            for name in S.RAW_SCHEMA.names
        ],
    )


def rule_predictions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Observations with a predicted class that any engine can recompute.

    The class of ``traffic_volume / 5000`` stands in for a model's prediction.
    """
    names = list(dict.fromkeys(["congestion_class", "traffic_volume", *columns]))
    return observations(spark, sf_dir, *names).select(
        *columns,
        F.col("congestion_class").alias("actual_congestion_class"),
        threshold_class(F.col("traffic_volume") / 5000.0).alias("predicted_congestion_class"),
    )
