"""Register of runnable queries, each with the SQL that must give the same rows.

The SQL is written for a plain SQL engine over the given tables. Both sides round
results of sums with ``r4``: a tiny shift before rounding keeps exact ties, and the last
bits that depend on the order of addition, from mattering.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadgrain import schemas as S
from roadgrain.sources.given import WEATHER_OF_SEGMENT, YEARLY_CALENDAR

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a function (spark, sf_dir) -> DataFrame under a name."""

    def add(run: Runner) -> Runner:
        if name in QUERIES:
            raise ValueError(f"Query {name} is registered twice.")
        QUERIES[name] = Query(run, sql)
        return run

    return add


def r4(column: Column | str) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value + F.lit(1e-7), 4) + F.lit(0.0)


def sql_r4(expression: str) -> str:
    return f"(round({expression} + 1e-7, 4) + 0e0)"


def rounded(data: DataFrame) -> DataFrame:
    """The same table with every double rounded by ``r4``."""
    return data.select(*[r4(name).alias(name) if kind == "double" else F.col(name) for name, kind in data.dtypes])


def _values(rows: list[tuple]) -> str:
    def text(value) -> str:
        if isinstance(value, bool) or isinstance(value, (int, float)):
            return str(value).lower()
        return "'" + value.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


CALENDAR_SQL = (
    "cal AS (SELECT make_date(y, m, d) AS date, festival_name, festival_flag, holiday_flag, "
    "'yearly template ' || y AS source "
    f"FROM (VALUES {_values(YEARLY_CALENDAR)}) t(m, d, festival_name, festival_flag, holiday_flag), "
    "(SELECT CAST(unnest(range((SELECT min(year(o_orderdate)) FROM orders), "
    "(SELECT max(year(o_orderdate)) FROM orders) + 1)) AS INTEGER) AS y) years)"
)


def sql_class(level: str) -> str:
    return (
        f"CASE WHEN {level} IS NULL THEN NULL WHEN {level} < {S.LOW_BELOW} THEN 'Low' "
        f"WHEN {level} < {S.MEDIUM_BELOW} THEN 'Medium' ELSE 'High' END"
    )


_WEATHER_SQL = " ".join(f"WHEN '{segment}' THEN '{name}'" for segment, name in WEATHER_OF_SEGMENT.items())

OBSERVATIONS_SQL = f"""base AS (
  SELECT o_orderkey AS obs_id, CAST(o_orderdate AS DATE) AS date, r_name AS area, n_name AS road_intersection,
    r_name || ' | ' || n_name AS corridor,
    o_totalprice * (0.9e0 + (o_custkey % 5) * 0.05e0) AS traffic_volume,
    20e0 + (c_acctbal + 1000) / 160e0 AS average_speed,
    1e0 + (o_custkey % 100) / 200e0 AS travel_time_index,
    o_totalprice / 5000e0 AS congestion_level,
    {sql_class("(o_totalprice / 5000e0)")} AS congestion_class,
    CASE c_mktsegment {_WEATHER_SQL} END AS weather,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Yes' ELSE 'No' END AS roadwork,
    CAST(dayofweek(CAST(o_orderdate AS DATE)) + 1 AS INTEGER) AS day_of_week,
    CASE WHEN dayofweek(CAST(o_orderdate AS DATE)) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey),
obs AS (
  SELECT base.*, coalesce(cal.festival_flag, false) AS festival_flag, cal.festival_name,
    coalesce(cal.holiday_flag, false) AS holiday_flag
  FROM base LEFT JOIN cal ON base.date = cal.date)"""

PREDICTIONS_SQL = f"""pred AS (
  SELECT obs.*, congestion_class AS actual_congestion_class,
    {sql_class("(traffic_volume / 5000e0)")} AS predicted_congestion_class FROM obs)"""


def over_observations(body: str, *more: str) -> str:
    """SQL with ``cal`` and ``obs`` defined, then further named parts, then the body."""
    return "WITH " + ",\n".join([CALENDAR_SQL, OBSERVATIONS_SQL, *more]) + "\n" + body


def over_predictions(body: str, *more: str) -> str:
    return over_observations(body, PREDICTIONS_SQL, *more)


ACTIONS_SQL = "actions AS (SELECT * FROM (VALUES {rows}) t(class, {columns}))".format(
    rows=_values([(name, *texts.values()) for name, texts in S.ADVISORY_RULES.items()]),
    columns=", ".join(S.ACTION_COLUMNS),
)
NOTES_SQL = (
    "concat_ws('; ', "
    f"CASE WHEN festival_flag THEN {sql_text(S.CONTEXT_NOTES['festival'])} END, "
    f"CASE WHEN holiday_flag THEN {sql_text(S.CONTEXT_NOTES['holiday'])} END, "
    f"CASE WHEN roadwork = 'Yes' THEN {sql_text(S.CONTEXT_NOTES['roadwork'])} END, "
    f"CASE WHEN weather IN ('Rain', 'Fog') THEN {sql_text(S.CONTEXT_NOTES['weather'])} END)"
)
