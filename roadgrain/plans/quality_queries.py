"""Registered queries: profiling, key checks, strict reads and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadgrain import schemas as S
from roadgrain.operators import contracts as C, gates as G, quality as K, scoring
from roadgrain.operators.advisory import advise, advise_predictions
from roadgrain.operators.split import cutoff_date, split_at, test_period
from roadgrain.operators.summaries import summarise_all
from roadgrain.plans.registry import (
    ACTIONS_SQL,
    NOTES_SQL,
    QUERIES,
    over_observations,
    over_predictions,
    query,
    rounded,
    sql_r4,
)
from roadgrain.plans.shape_queries import CUTOFF_SQL
from roadgrain.plans.summary_queries import MATRIX_SQL, metrics_sql
from roadgrain.session import fresh_path
from roadgrain.sources import reports
from roadgrain.sources.given import observations, rule_predictions, table


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@query(
    "K1_null_counts",
    over_observations(
        _union(
            [
                f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS null_count FROM obs"
                for name in S.INTEGRATED_COLUMNS
            ]
        )
    ),
)
def null_counts(spark, sf_dir):
    return K.null_counts(observations(spark, sf_dir, *S.INTEGRATED_COLUMNS))


_DUPLICATE_SQL = "SELECT count(*) AS n FROM obs GROUP BY date, corridor HAVING count(*) > 1"


@query(
    "K2_duplicate_key_count",
    over_observations(f"SELECT count(*) AS duplicate_key_count FROM ({_DUPLICATE_SQL})"),
)
def duplicate_key_count(spark, sf_dir):
    return K.duplicate_key_count(observations(spark, sf_dir, "date", "corridor"), ["date", "corridor"])


@query(
    "K2_duplicate_keys",
    over_observations(
        "SELECT date, corridor, count(*) AS row_count FROM obs GROUP BY date, corridor HAVING count(*) > 1"
    ),
)
def duplicate_keys(spark, sf_dir):
    return K.duplicate_keys(observations(spark, sf_dir, "date", "corridor"), ["date", "corridor"])


_ALL_COLUMNS_SQL = (
    "date, area, road_intersection, corridor, traffic_volume, average_speed, travel_time_index, congestion_level, "
    "congestion_class, weather, roadwork, day_of_week, day_type, festival_flag, festival_name, holiday_flag"
)


@query(
    "K3_surplus_duplicates",
    over_observations(
        "SELECT count(*) AS row_count, (SELECT count(*) FROM d) AS distinct_row_count, "
        "count(*) - (SELECT count(*) FROM d) AS duplicate_rows FROM obs",
        f"d AS (SELECT DISTINCT {_ALL_COLUMNS_SQL} FROM obs)",
    ),
)
def surplus_duplicates(spark, sf_dir):
    return K.surplus_rows(observations(spark, sf_dir, *S.INTEGRATED_COLUMNS))


@query("K4_distinct_values", over_observations("SELECT DISTINCT weather FROM obs ORDER BY weather"))
def distinct_values(spark, sf_dir):
    return K.distinct_values(observations(spark, sf_dir, "weather"), "weather")


@query(
    "K5_distinct_counts",
    over_observations(
        _union(
            [
                f"SELECT '{name}' AS column_name, count(DISTINCT {name}) AS distinct_count FROM obs"
                for name in S.CATEGORICAL_FEATURES
            ]
        )
    ),
)
def distinct_counts(spark, sf_dir):
    return K.distinct_counts(observations(spark, sf_dir, *S.CATEGORICAL_FEATURES), S.CATEGORICAL_FEATURES)


@query("K6_date_bounds", over_observations("SELECT min(date) AS minimum, max(date) AS maximum FROM obs"))
def date_bounds(spark, sf_dir):
    return K.bounds(observations(spark, sf_dir, "date"))


@query(
    "K7_numeric_summary",
    over_observations(
        _union(
            [
                f"SELECT '{name}' AS column_name, count({name}) AS count, {sql_r4(f'min({name})')} AS minimum, "
                f"{sql_r4(f'max({name})')} AS maximum, {sql_r4(f'avg({name})')} AS mean, "
                f"{sql_r4(f'stddev_samp({name})')} AS stddev FROM obs"
                for name in S.NUMERIC_MEASURES
            ]
        )
    ),
)
def numeric_summary(spark, sf_dir):
    return rounded(K.numeric_summary(observations(spark, sf_dir, *S.NUMERIC_MEASURES), S.NUMERIC_MEASURES))


# --------------------------------------------------------- raw text file checks
def _traffic_cells(spark, sf_dir) -> DataFrame:
    """Text cells shaped like the raw traffic file, with faults and without ``weather``."""
    key, place = F.col("obs_id"), F.col("road_intersection")
    rows = observations(spark, sf_dir, "obs_id", "date", "road_intersection", S.TARGET, "day_type")
    time = (
        F.when(key % 211 == 0, "not-a-time")
        .when(key % 223 == 0, "1999-02-30 08:00:00")
        .otherwise(F.concat(F.col("date").cast("string"), F.lit(" 08:00:00")))
    )
    cells = rows.select(
        time.alias("timestamp"),
        F.when(key % 101 == 0, "  ").otherwise(place).alias("junction"),
        F.when(key % 131 != 0, (key % 1000).cast("string")).alias("traffic_volume"),
        F.col(S.TARGET).alias("congestion_level"),
        F.col("day_type").alias("signal_status"),
        F.explode(F.array_repeat(F.lit(True), F.when(key % 97 == 0, 2).otherwise(1))).alias("copy"),
    )
    return cells.drop("copy")


_TRAFFIC_CELLS_SQL = (
    "c1 AS (SELECT obs_id, CASE WHEN obs_id % 211 = 0 THEN 'not-a-time' WHEN obs_id % 223 = 0 THEN '1999-02-30 08:00:00' "
    "ELSE CAST(date AS VARCHAR) || ' 08:00:00' END AS timestamp, "
    "CASE WHEN obs_id % 101 = 0 THEN '  ' ELSE road_intersection END AS junction, "
    "CASE WHEN obs_id % 131 <> 0 THEN CAST(obs_id % 1000 AS VARCHAR) END AS traffic_volume, "
    "congestion_class AS congestion_level, day_type AS signal_status FROM obs), "
    "traffic AS (SELECT * EXCLUDE (obs_id, copy) FROM (SELECT *, unnest(range(CASE WHEN obs_id % 97 = 0 THEN 2 ELSE 1 END)) AS copy FROM c1))"
)


def _findings_sql(cells: str, wanted: C.RawFile, present: list[str]) -> str:
    parts = [
        f"SELECT 'missing column' AS \"check\", '{n}' AS column_name, CAST(0 AS BIGINT) AS row_count, CAST(NULL AS VARCHAR) AS detail"
        for n in wanted.columns
        if n not in present
    ]
    parts += [
        f"SELECT 'missing values', '{n}', count(*), NULL FROM {cells} WHERE trim(coalesce({n}, '')) = '' HAVING count(*) > 0"
        for n in wanted.columns
        if n in present
    ]
    parts.append(
        f"SELECT 'duplicate rows', '', (SELECT count(*) FROM {cells}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {cells})), "
        f"NULL WHERE (SELECT count(*) FROM {cells}) > (SELECT count(*) FROM (SELECT DISTINCT * FROM {cells}))"
    )
    kind = "DATE" if wanted.time_kind == "date" else "TIMESTAMP"
    parts.append(
        f"SELECT 'invalid time', '{wanted.time_column}', count(*), {wanted.time_column} FROM {cells} "
        f"WHERE TRY_CAST({wanted.time_column} AS {kind}) IS NULL GROUP BY {wanted.time_column}"
    )
    return _union(parts)


_TRAFFIC_PRESENT = ["timestamp", "junction", "traffic_volume", "congestion_level", "signal_status"]
_TRAFFIC_FINDINGS = _findings_sql("traffic", C.RAW_FILES["traffic.csv"], _TRAFFIC_PRESENT)


@query("K8_raw_file_findings", over_observations(_TRAFFIC_FINDINGS, _TRAFFIC_CELLS_SQL))
def raw_file_findings(spark, sf_dir):
    return C.raw_file_findings(_traffic_cells(spark, sf_dir), C.RAW_FILES["traffic.csv"]).fillna(0, ["row_count"])


@query(
    "K8_raw_file_profile",
    over_observations(
        "SELECT count(*) AS row_count, CAST(min(TRY_CAST(timestamp AS TIMESTAMP)) AS VARCHAR) AS minimum_time, "
        "CAST(max(TRY_CAST(timestamp AS TIMESTAMP)) AS VARCHAR) AS maximum_time, "
        "string_agg(DISTINCT junction, ', ' ORDER BY junction) AS junction_values, "
        "string_agg(DISTINCT congestion_level, ', ' ORDER BY congestion_level) AS congestion_level_values, "
        "string_agg(DISTINCT signal_status, ', ' ORDER BY signal_status) AS signal_status_values FROM traffic",
        _TRAFFIC_CELLS_SQL,
    ),
)
def raw_file_profile(spark, sf_dir):
    profile = C.raw_file_profile(_traffic_cells(spark, sf_dir), C.RAW_FILES["traffic.csv"])
    values = [name for name in profile.columns if name.endswith("_values")]
    return profile.withColumns({name: F.array_join(name, ", ") for name in values})


@query(
    "K8_category_values",
    over_observations(
        _union(
            [
                f"SELECT '{n}' AS column_name, {n} AS value, count(*) AS row_count FROM traffic GROUP BY {n}"
                for n in ("junction", "congestion_level", "signal_status")
            ]
        ),
        _TRAFFIC_CELLS_SQL,
    ),
)
def category_values(spark, sf_dir):
    return C.category_values(_traffic_cells(spark, sf_dir), C.RAW_FILES["traffic.csv"])


def _toll_cells(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        F.when(F.col("l_partkey") % 37 == 0, F.lit("soon"))
        .otherwise(F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 06:00:00")))
        .alias("timestamp"),
        F.when(F.col("l_suppkey") % 19 != 0, F.concat(F.lit("plaza "), F.col("l_suppkey"))).alias("toll_plaza"),
        F.col("l_quantity").cast("int").cast("string").alias("vehicle_count"),
        F.col("l_linenumber").cast("string").alias("transaction_count"),
    )


_TOLL_CELLS_SQL = (
    "toll AS (SELECT CASE WHEN l_partkey % 37 = 0 THEN 'soon' ELSE strftime(l_shipdate, '%Y-%m-%d') || ' 06:00:00' END "
    "AS timestamp, CASE WHEN l_suppkey % 19 <> 0 THEN 'plaza ' || l_suppkey END AS toll_plaza, "
    "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS vehicle_count, CAST(l_linenumber AS VARCHAR) AS transaction_count "
    "FROM lineitem)"
)


def _calendar_cells(spark, sf_dir) -> DataFrame:
    days = observations(spark, sf_dir, "date", "festival_name", "festival_flag", "holiday_flag", "day_type").distinct()
    return days.select(
        F.col("date").cast("string").alias("date"),
        F.coalesce("festival_name", F.lit("None")).alias("festival_name"),
        F.col("festival_flag").cast("string").alias("is_festival"),
        F.col("holiday_flag").cast("string").alias("is_holiday"),
        "day_type",
    )


_CALENDAR_CELLS_SQL = (
    "days AS (SELECT DISTINCT CAST(date AS VARCHAR) AS date, coalesce(festival_name, 'None') AS festival_name, "
    "CAST(festival_flag AS VARCHAR) AS is_festival, CAST(holiday_flag AS VARCHAR) AS is_holiday, day_type FROM obs)"
)


@query(
    "K9_registry_findings",
    over_observations(
        f"SELECT 'traffic.csv' AS dataset, t.* FROM ({_TRAFFIC_FINDINGS}) t UNION ALL SELECT 'toll.csv', t.* FROM ("
        + _findings_sql("toll", C.RAW_FILES["toll.csv"], list(C.RAW_FILES["toll.csv"].columns))
        + ") t UNION ALL SELECT 'signal.csv', 'missing file', '', 0, NULL UNION ALL SELECT 'festival_calendar.csv', t.* FROM ("
        + _findings_sql(
            "days", C.RAW_FILES["festival_calendar.csv"], list(C.RAW_FILES["festival_calendar.csv"].columns)
        )
        + ") t",
        _TRAFFIC_CELLS_SQL,
        _TOLL_CELLS_SQL,
        _CALENDAR_CELLS_SQL,
    ),
)
def registry_findings(spark, sf_dir):
    return C.registry_findings(
        spark,
        {
            "traffic.csv": _traffic_cells(spark, sf_dir),
            "toll.csv": _toll_cells(spark, sf_dir),
            "signal.csv": None,
            "festival_calendar.csv": _calendar_cells(spark, sf_dir),
        },
    ).fillna(0, ["row_count"])


def _write_cells(cells: DataFrame, path: str) -> None:
    """Text cells as CSV files with a header, blanks as they are."""
    writer = cells.write.mode("append").option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


@query(
    "K9_folder_findings",
    over_observations(
        f"SELECT 'traffic.csv' AS dataset, t.* FROM ({_TRAFFIC_FINDINGS}) t UNION ALL SELECT 'toll.csv', t.* FROM ("
        + _findings_sql("toll", C.RAW_FILES["toll.csv"], list(C.RAW_FILES["toll.csv"].columns))
        + ") t UNION ALL SELECT 'signal.csv', 'missing file', '', 0, NULL "
        "UNION ALL SELECT 'festival_calendar.csv', 'empty file', '', 0, NULL",
        _TRAFFIC_CELLS_SQL,
        _TOLL_CELLS_SQL,
    ),
)
def folder_findings(spark, sf_dir):
    """The files are written from the tables first: one absent, one without a header, one in two column orders."""
    folder = fresh_path(spark, "raw-folder")
    _write_cells(_traffic_cells(spark, sf_dir), f"{folder}/traffic.csv")
    toll = _toll_cells(spark, sf_dir)
    early = F.col("transaction_count").cast("int") <= 2
    _write_cells(toll.where(early), f"{folder}/toll.csv")
    _write_cells(toll.where(~early).select(*reversed(toll.columns)), f"{folder}/toll.csv")
    toll.where("false").select("timestamp").union(spark.range(1).select(F.lit(""))).coalesce(1).write.text(
        f"{folder}/festival_calendar.csv"
    )
    return C.folder_findings(spark, folder).fillna(0, ["row_count"])


# ---------------------------------------------------------------- strict reads
def _report_sql(found: str) -> str:
    return (
        f"SELECT issue, column_name, count(*) AS row_count, min(cell) AS example FROM ({found}) GROUP BY issue, column_name"
    )


def _issue_sql(cells: str, issue: str, column: str, condition: str) -> str:
    return f"SELECT '{issue}' AS issue, '{column}' AS column_name, {column} AS cell FROM {cells} WHERE {condition}"


#: Cells that are no decimal numbers, though a plain cast takes some of them.
_NO_NUMBERS = ["half", "12.5d", "0x1p3", "3f"]


def _corridor_cells(spark, sf_dir) -> DataFrame:
    """One text row per order shaped like a high-congestion summary, with faults."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 311 == 0, "")
        .when(key % 313 == 0, F.concat(F.lit("c"), key - 1))
        .otherwise(F.concat(F.lit("c"), key))
        .alias("corridor"),
        F.when(key % 101 == 0, F.lit(None))
        .when(key % 103 == 0, "12.5")
        .when(key % 107 == 0, "-3")
        .otherwise((key % 900).cast("string"))
        .alias("total_records"),
        F.when(key % 109 == 0, "many").otherwise((key % 90).cast("string")).alias("high_congestion_count"),
        F.when(key % 113 == 0, F.element_at(F.array(*[F.lit(x) for x in _NO_NUMBERS]), (key % 4 + 1).cast("int")))
        .when(key % 127 == 0, "101.5")
        .otherwise(F.concat((key % 99).cast("string"), F.lit(".5")))
        .alias("high_congestion_percentage"),
        F.col("o_orderstatus").alias("extra"),
    )


_CORRIDOR_CELLS_SQL = (
    "cells AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 311 = 0 THEN '' WHEN o_orderkey % 313 = 0 THEN 'c' || (o_orderkey - 1) "
    "ELSE 'c' || o_orderkey END AS corridor, "
    "CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN '12.5' WHEN o_orderkey % 107 = 0 THEN '-3' "
    "ELSE CAST(o_orderkey % 900 AS VARCHAR) END AS total_records, "
    "CASE WHEN o_orderkey % 109 = 0 THEN 'many' ELSE CAST(o_orderkey % 90 AS VARCHAR) END AS high_congestion_count, "
    "CASE WHEN o_orderkey % 113 = 0 THEN ['half', '12.5d', '0x1p3', '3f'][o_orderkey % 4 + 1] "
    "WHEN o_orderkey % 127 = 0 THEN '101.5' "
    "ELSE CAST(o_orderkey % 99 AS VARCHAR) || '.5' END AS high_congestion_percentage FROM orders)"
)


@query(
    "K10_strict_read_issues",
    f"WITH {_CORRIDOR_CELLS_SQL} "
    + _report_sql(
        _union(
            [
                _issue_sql("cells", "incomplete", "total_records", "total_records IS NULL"),
                _issue_sql("cells", "invalid integer", "total_records", "total_records = '12.5'"),
                _issue_sql("cells", "out of range", "total_records", "total_records = '-3'"),
                _issue_sql("cells", "invalid integer", "high_congestion_count", "high_congestion_count = 'many'"),
                _issue_sql("cells", "invalid number", "high_congestion_percentage", "high_congestion_percentage IN ('half', '12.5d', '0x1p3', '3f')"),
                _issue_sql("cells", "out of range", "high_congestion_percentage", "high_congestion_percentage = '101.5'"),
                _issue_sql("cells", "empty key", "corridor", "corridor = ''"),
                _issue_sql(
                    "cells",
                    "duplicate key",
                    "corridor",
                    "corridor <> '' AND corridor IN (SELECT corridor FROM cells GROUP BY corridor HAVING count(*) > 1)",
                ),
            ]
        )
    ),
)
def strict_read_issues(spark, sf_dir):
    return C.issue_report(C.check_rows(_corridor_cells(spark, sf_dir), C.HIGH_CONGESTION))


@query(
    "K10_strict_read_good_rows",
    f"WITH {_CORRIDOR_CELLS_SQL} SELECT corridor, CAST(total_records AS BIGINT) AS total_records, "
    "CAST(high_congestion_count AS BIGINT) AS high_congestion_count, "
    "TRY_CAST(high_congestion_percentage AS DOUBLE) AS high_congestion_percentage FROM cells "
    "WHERE total_records IS NOT NULL AND total_records NOT IN ('12.5', '-3') AND high_congestion_count <> 'many' "
    "AND high_congestion_percentage NOT IN ('half', '12.5d', '0x1p3', '3f', '101.5') AND corridor <> '' "
    "AND corridor NOT IN (SELECT corridor FROM cells GROUP BY corridor HAVING count(*) > 1)",
)
def strict_read_good_rows(spark, sf_dir):
    return C.good_rows(C.check_rows(_corridor_cells(spark, sf_dir), C.HIGH_CONGESTION), C.HIGH_CONGESTION)


def _day_cells(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    number = F.concat((key % 70).cast("string"), F.lit(".25"))
    return table(spark, sf_dir, "orders").select(
        F.when(key % 101 == 0, "8").when(key % 103 == 0, "Monday").otherwise((key % 7 + 1).cast("string")).alias("day_of_week"),
        F.when(key % 107 == 0, "").otherwise((key % 900).cast("string")).alias("record_count"),
        F.when(key % 109 == 0, "NaN").otherwise(number).alias("average_traffic_volume"),
        F.when(key % 113 == 0, "Infinity").otherwise(number).alias("average_speed"),
        F.when(key % 127 == 0, "fast").otherwise(number).alias("average_congestion_level"),
        F.when(key % 131 == 0, "-0.5").otherwise(number).alias("high_congestion_percentage"),
    )


_DAY_CELLS_SQL = (
    "cells AS (SELECT CASE WHEN k % 101 = 0 THEN '8' WHEN k % 103 = 0 THEN 'Monday' ELSE CAST(k % 7 + 1 AS VARCHAR) END AS day_of_week, "
    "CASE WHEN k % 107 = 0 THEN '' ELSE CAST(k % 900 AS VARCHAR) END AS record_count, "
    "CASE WHEN k % 109 = 0 THEN 'NaN' ELSE v END AS average_traffic_volume, "
    "CASE WHEN k % 113 = 0 THEN 'Infinity' ELSE v END AS average_speed, "
    "CASE WHEN k % 127 = 0 THEN 'fast' ELSE v END AS average_congestion_level, "
    "CASE WHEN k % 131 = 0 THEN '-0.5' ELSE v END AS high_congestion_percentage "
    "FROM (SELECT o_orderkey AS k, (o_orderkey % 70) || '.25' AS v FROM orders))"
)


@query(
    "K11_temporal_read_issues",
    f"WITH {_DAY_CELLS_SQL} "
    + _report_sql(
        _union(
            [
                _issue_sql("cells", "out of range", "day_of_week", "day_of_week = '8'"),
                _issue_sql("cells", "invalid integer", "day_of_week", "day_of_week = 'Monday'"),
                _issue_sql("cells", "incomplete", "record_count", "record_count = ''"),
                _issue_sql("cells", "non-finite number", "average_traffic_volume", "average_traffic_volume = 'NaN'"),
                _issue_sql("cells", "non-finite number", "average_speed", "average_speed = 'Infinity'"),
                _issue_sql("cells", "invalid number", "average_congestion_level", "average_congestion_level = 'fast'"),
                _issue_sql("cells", "out of range", "high_congestion_percentage", "high_congestion_percentage = '-0.5'"),
            ]
        )
    ),
)
def temporal_read_issues(spark, sf_dir):
    return C.issue_report(C.check_rows(_day_cells(spark, sf_dir), C.DAY_OF_WEEK_SUMMARY))


# Files whose column orders differ, with short and long lines.
def _write_lines(cells: DataFrame, path: str, key: Column) -> None:
    """CSV lines in two column orders: even keys in the given one, odd ones reversed behind a note.

    Some lines lack their last field, some have one too many. A separator that no line has keeps the
    writer from quoting them.
    """
    columns = [name for name in cells.columns if name != "k"]
    for odd, names in enumerate([columns, ["note", *reversed(columns)]]):
        fields = [F.lit("n") if name == "note" else F.col(name) for name in names]
        line = F.concat_ws(",", *fields)
        short, long = F.concat_ws(",", *fields[:-1]), F.concat(line, F.lit(",x"))
        written = F.when(key % 401 == 0, short).when(key % 409 == 0, long).otherwise(line)
        lines = cells.where(key % 2 == odd).select(written.alias(",".join(names)))
        lines.write.mode("append").option("header", True).option("sep", "\u0001").csv(path)


def _lines_sql(columns: list[str]) -> str:
    """``cells``, given as ``good`` with a key k, after it was written by ``_write_lines``.

    A field may be lost, and in a line with too few or too many fields an empty one counts as lost.
    """
    lost = {columns[0]: 1, columns[-1]: 0}
    fields = [
        f"CASE WHEN k % 401 = 0 AND k % 2 = {lost.get(name, 2)} THEN NULL "
        f"WHEN k % 401 = 0 OR k % 409 = 0 THEN nullif({name}, '') ELSE {name} END AS {name}"
        for name in columns
    ]
    even, odd = " || ',' || ".join(columns), "'n,' || " + " || ',' || ".join(reversed(columns))
    short = " || ',' || ".join(columns[:-1]), "'n,' || " + " || ',' || ".join(reversed(columns[1:]))
    raw = (
        f"CASE WHEN k % 401 = 0 THEN CASE WHEN k % 2 = 0 THEN {short[0]} ELSE {short[1]} END "
        f"WHEN k % 409 = 0 THEN CASE WHEN k % 2 = 0 THEN {even} ELSE {odd} END || ',x' END AS raw"
    )
    return f"cells AS (SELECT k, {', '.join(fields)}, {raw} FROM good)"


_MALFORMED_SQL = "SELECT 'wrong number of fields' AS issue, '' AS column_name, raw AS cell FROM cells WHERE raw IS NOT NULL"


def _summary_cells(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")

    def number(modulus: int, text: str = ""):
        return F.concat((key % modulus).cast("string"), F.lit(text))

    return table(spark, sf_dir, "orders").select(
        key.alias("k"),
        F.when(key % 311 == 0, "").when(key % 313 == 0, F.concat(F.lit("c"), key - 1)).otherwise(F.concat(F.lit("c"), key)).alias("corridor"),
        F.when(key % 103 == 0, "12.5").otherwise(number(900)).alias("record_count"),
        F.when(key % 113 == 0, "half").otherwise(number(99, ".5")).alias("average_traffic_volume"),
        number(60, ".25").alias("average_speed"),
        F.when(key % 117 == 0, "12.5d").otherwise(number(95, ".75")).alias("average_congestion_level"),
        number(3, ".5").alias("average_travel_time_index"),
        number(90).alias("low_congestion_count"),
        F.when(key % 127 == 0, "").otherwise(number(80)).alias("medium_congestion_count"),
        F.when(key % 109 == 0, "many").otherwise(number(70)).alias("high_congestion_count"),
    )


_SUMMARY_SQL = (
    "good AS (SELECT k, CASE WHEN k % 311 = 0 THEN '' WHEN k % 313 = 0 THEN 'c' || (k - 1) ELSE 'c' || k END AS corridor, "
    "CASE WHEN k % 103 = 0 THEN '12.5' ELSE CAST(k % 900 AS VARCHAR) END AS record_count, "
    "CASE WHEN k % 113 = 0 THEN 'half' ELSE (k % 99) || '.5' END AS average_traffic_volume, (k % 60) || '.25' AS average_speed, "
    "CASE WHEN k % 117 = 0 THEN '12.5d' ELSE (k % 95) || '.75' END AS average_congestion_level, "
    "(k % 3) || '.5' AS average_travel_time_index, CAST(k % 90 AS VARCHAR) AS low_congestion_count, "
    "CASE WHEN k % 127 = 0 THEN '' ELSE CAST(k % 80 AS VARCHAR) END AS medium_congestion_count, "
    "CASE WHEN k % 109 = 0 THEN 'many' ELSE CAST(k % 70 AS VARCHAR) END AS high_congestion_count "
    "FROM (SELECT o_orderkey AS k FROM orders)), " + _lines_sql(C.CORRIDOR_SUMMARY.columns)
)


@query(
    "K10_corridor_summary_issues",
    f"WITH {_SUMMARY_SQL} "
    + _report_sql(
        _union(
            [
                _MALFORMED_SQL,
                _issue_sql("cells", "incomplete", "corridor", "corridor IS NULL"),
                _issue_sql("cells", "incomplete", "high_congestion_count", "high_congestion_count IS NULL"),
                _issue_sql("cells", "incomplete", "medium_congestion_count", "medium_congestion_count IS NULL"),
                _issue_sql("cells", "empty key", "corridor", "corridor = ''"),
                _issue_sql(
                    "cells",
                    "duplicate key",
                    "corridor",
                    "corridor <> '' AND corridor IN (SELECT corridor FROM cells GROUP BY corridor HAVING count(*) > 1)",
                ),
                _issue_sql("cells", "invalid integer", "record_count", "record_count = '12.5'"),
                _issue_sql("cells", "invalid integer", "medium_congestion_count", "medium_congestion_count = ''"),
                _issue_sql("cells", "invalid integer", "high_congestion_count", "high_congestion_count = 'many'"),
                _issue_sql("cells", "invalid number", "average_traffic_volume", "average_traffic_volume = 'half'"),
                _issue_sql("cells", "invalid number", "average_congestion_level", "average_congestion_level = '12.5d'"),
            ]
        )
    ),
)
def corridor_summary_issues(spark, sf_dir):
    folder = fresh_path(spark, "corridor-summary")
    _write_lines(_summary_cells(spark, sf_dir), folder, F.col("k"))
    return C.issue_report(C.check_files(spark, folder, C.CORRIDOR_SUMMARY))


def _day_type_cells(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    number = F.concat((key % 70).cast("string"), F.lit(".25"))
    return table(spark, sf_dir, "orders").select(
        key.alias("k"),
        F.when(key % 101 == 0, "").when(key % 7 < 2, "Weekend").otherwise("Weekday").alias("day_type"),
        F.when(key % 103 == 0, "-2").when(key % 107 == 0, "1e3").otherwise((key % 900).cast("string")).alias("record_count"),
        F.when(key % 109 == 0, "NaN").otherwise(number).alias("average_traffic_volume"),
        F.when(key % 113 == 0, "-inf").otherwise(number).alias("average_speed"),
        F.when(key % 127 == 0, "fast").otherwise(number).alias("average_congestion_level"),
        F.when(key % 131 == 0, "").otherwise(number).alias("average_travel_time_index"),
        (key % 50).cast("string").alias("high_congestion_count"),
        F.when(key % 137 == 0, "100.5").otherwise(number).alias("high_congestion_percentage"),
    )


_DAY_TYPE_SQL = (
    "good AS (SELECT k, CASE WHEN k % 101 = 0 THEN '' WHEN k % 7 < 2 THEN 'Weekend' ELSE 'Weekday' END AS day_type, "
    "CASE WHEN k % 103 = 0 THEN '-2' WHEN k % 107 = 0 THEN '1e3' ELSE CAST(k % 900 AS VARCHAR) END AS record_count, "
    "CASE WHEN k % 109 = 0 THEN 'NaN' ELSE v END AS average_traffic_volume, "
    "CASE WHEN k % 113 = 0 THEN '-inf' ELSE v END AS average_speed, "
    "CASE WHEN k % 127 = 0 THEN 'fast' ELSE v END AS average_congestion_level, "
    "CASE WHEN k % 131 = 0 THEN '' ELSE v END AS average_travel_time_index, CAST(k % 50 AS VARCHAR) AS high_congestion_count, "
    "CASE WHEN k % 137 = 0 THEN '100.5' ELSE v END AS high_congestion_percentage "
    "FROM (SELECT o_orderkey AS k, (o_orderkey % 70) || '.25' AS v FROM orders)), " + _lines_sql(C.DAY_TYPE_SUMMARY.columns)
)


@query(
    "K11_day_type_issues",
    f"WITH {_DAY_TYPE_SQL} "
    + _report_sql(
        _union(
            [
                _MALFORMED_SQL,
                _issue_sql("cells", "incomplete", "day_type", "coalesce(day_type, '') = ''"),
                _issue_sql("cells", "incomplete", "average_travel_time_index", "coalesce(average_travel_time_index, '') = ''"),
                _issue_sql("cells", "incomplete", "high_congestion_percentage", "high_congestion_percentage IS NULL"),
                _issue_sql("cells", "out of range", "record_count", "record_count = '-2'"),
                _issue_sql("cells", "invalid integer", "record_count", "record_count = '1e3'"),
                _issue_sql("cells", "non-finite number", "average_traffic_volume", "average_traffic_volume = 'NaN'"),
                _issue_sql("cells", "non-finite number", "average_speed", "average_speed = '-inf'"),
                _issue_sql("cells", "invalid number", "average_congestion_level", "average_congestion_level = 'fast'"),
                _issue_sql("cells", "out of range", "high_congestion_percentage", "high_congestion_percentage = '100.5'"),
            ]
        )
    ),
)
def day_type_issues(spark, sf_dir):
    folder = fresh_path(spark, "day-types")
    _write_lines(_day_type_cells(spark, sf_dir), folder, F.col("k"))
    return C.issue_report(C.check_files(spark, folder, C.DAY_TYPE_SUMMARY))


def _advisory_cells(spark, sf_dir) -> DataFrame:
    rows = advise(observations(spark, sf_dir), "obs_id")
    key = F.col("obs_id")
    faults = {
        "date": F.when(key % 101 == 0, "1999-1-5").when(key % 103 == 0, "soon").otherwise(F.col("date").cast("string")),
        "festival_flag": F.when(key % 107 == 0, "yes").otherwise(F.initcap(F.col("festival_flag").cast("string"))),
        "roadwork": F.when(key % 109 == 0, "Maybe").otherwise(F.col("roadwork")),
        "congestion_class": F.when(key % 113 == 0, "Severe").otherwise(F.col(S.TARGET)),
        "weather": F.when(key % 127 == 0, "").otherwise(F.col("weather")),
        "holiday_flag": F.col("holiday_flag").cast("string"),
    }
    return rows.select(*[faults.get(name, F.col(name)).alias(name) for name in S.ADVISORY_COLUMNS])


@query(
    "K12_advisory_read_issues",
    over_observations(
        _report_sql(
            _union(
                [
                    "SELECT 'invalid date' AS issue, 'date' AS column_name, CASE WHEN obs_id % 101 = 0 THEN '1999-1-5' ELSE 'soon' END "
                    "AS cell FROM obs WHERE obs_id % 101 = 0 OR obs_id % 103 = 0",
                    "SELECT 'invalid boolean', 'festival_flag', 'yes' FROM obs WHERE obs_id % 107 = 0",
                    "SELECT 'unsupported value', 'roadwork', 'Maybe' FROM obs WHERE obs_id % 109 = 0",
                    "SELECT 'unsupported value', 'congestion_class', 'Severe' FROM obs WHERE obs_id % 113 = 0",
                    "SELECT 'incomplete', 'weather', '' FROM obs WHERE obs_id % 127 = 0",
                ]
            )
        )
    ),
)
def advisory_read_issues(spark, sf_dir):
    return C.issue_report(C.check_rows(_advisory_cells(spark, sf_dir), C.ADVISORY_ROWS))


@query("K12_advisory_file_issues", QUERIES["K12_advisory_read_issues"].sql)
def advisory_file_issues(spark, sf_dir):
    """The same advisories from CSV files, half of which have their columns reversed."""
    cells, folder = _advisory_cells(spark, sf_dir), fresh_path(spark, "advisories")
    high = F.col("advisory_level") == "High"
    _write_cells(cells.where(high), folder)
    _write_cells(cells.where(~high).select(*reversed(cells.columns)), folder)
    return C.issue_report(C.check_files(spark, folder, C.ADVISORY_ROWS))


# ------------------------------------------------------------- feature inspection
# ---------------------------------------------------------------- fixed values
_INSPECTED = {
    "numeric": ["traffic_volume", "average_speed", "travel_time_index", "congestion_level"],
    "categorical": ["corridor", "area", "road_intersection", "weather", "roadwork", "day_type"],
    "temporal": ["day_of_week", "festival_flag", "holiday_flag"],
}
_INSPECTED_SQL = {
    name: f"SELECT '{name}' AS feature, '{group}' AS feature_group, true AS available, "
    f"{str(name != 'congestion_level').lower()} AS used, count(*) FILTER ({name} IS NULL) AS null_count, "
    f"{'-1' if group == 'numeric' else f'count(DISTINCT {name})'}::BIGINT AS distinct_count FROM obs"
    for group, names in _INSPECTED.items()
    for name in names
}
_ABSENT = {
    "numeric": [
        "road_capacity_utilization",
        "incident_reports",
        "environmental_impact",
        "public_transport_usage",
        "traffic_signal_compliance",
        "parking_usage",
        "pedestrian_and_cyclist_count",
    ],
    "unavailable": [
        "hour",
        "direction",
        "GPS coordinates",
        "live traffic features",
        "FASTag features",
        "signal-event features",
    ],
}
# ------------------------------------------------------------ end fixed values
_ABSENT_SQL = [f"SELECT '{name}', '{group}', false, false, -1, -1" for group, names in _ABSENT.items() for name in names]


@query("K13_all_candidates", over_observations(_union([*_INSPECTED_SQL.values(), *_ABSENT_SQL])))
def all_candidates(spark, sf_dir):
    """Every candidate and every feature listed as unavailable, on the untouched table; -1 where there is no count."""
    inspected = K.feature_inspection(observations(spark, sf_dir, *S.INTEGRATED_COLUMNS))
    return inspected.fillna(-1, ["null_count", "distinct_count"])


@query(
    "K14_excluded_features",
    over_observations(
        _union(
            [
                f"SELECT '{name}' AS column_name, '{reason}' AS reason, count({name}) AS non_null_count FROM obs"
                for name, reason in S.EXCLUDED_FEATURES.items()
            ]
        )
    ),
)
def excluded_features(spark, sf_dir):
    return K.feature_exclusions(observations(spark, sf_dir, *S.EXCLUDED_FEATURES))


# ----------------------------------------------------------------------- gates
def _checks_sql(conditions: dict[str, str]) -> str:
    return _union([f"SELECT '{name}' AS name, ({condition}) AS passed" for name, condition in conditions.items()])


@query(
    "G1_rows_kept",
    over_observations(_checks_sql({"rows_kept": "(SELECT count(*) FROM obs) = (SELECT count(*) FROM orders)"})),
)
def rows_kept(spark, sf_dir):
    return G.rows_kept(table(spark, sf_dir, "orders"), observations(spark, sf_dir))


@query(
    "G2_expected_size",
    over_observations(
        _checks_sql(
            {
                "expected_rows": "(SELECT count(*) FROM obs) = (SELECT count(*) FROM orders)",
                "expected_corridors": "(SELECT count(DISTINCT corridor) FROM obs) = 16",
            }
        )
    ),
)
def expected_size(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").agg(F.count(F.lit(1))).scalar()
    return G.expected_size(observations(spark, sf_dir, "corridor"), rows, 16)


@query(
    "G3_target_domain",
    over_observations(
        _checks_sql(
            {
                "every_class_present": "(SELECT count(DISTINCT congestion_class) FROM obs WHERE congestion_class IN ('Low', 'Medium', 'High')) = 3",
                "no_other_value": "(SELECT count(*) FROM obs WHERE coalesce(congestion_class, '') NOT IN ('Low', 'Medium', 'High')) = 0",
            }
        )
    ),
)
def target_domain(spark, sf_dir):
    return G.target_domain(observations(spark, sf_dir, S.TARGET))


def _rule_metrics(spark, sf_dir) -> DataFrame:
    return scoring.weighted_metrics(scoring.confusion_matrix(rule_predictions(spark, sf_dir)))


@query(
    "G4_split_quality",
    over_predictions(
        _checks_sql(
            {
                "halves_add_up": "(SELECT count(*) FILTER (date <= DATE '2000-01-01') + count(*) FILTER (date > DATE '2000-01-01') "
                "= count(*) FROM obs)",
                "no_null_target": "(SELECT count(*) FILTER (congestion_class IS NULL) FROM obs) = 0",
                "no_null_feature": "(SELECT count(*) FROM obs WHERE "
                + " OR ".join(f"{name} IS NULL" for name in S.FEATURES)
                + ") = 0",
                "training_before_testing": "(SELECT max(date) FROM obs WHERE date <= DATE '2000-01-01') < "
                "(SELECT min(date) FROM obs WHERE date > DATE '2000-01-01')",
                "metrics_in_range": "(SELECT bool_and(value BETWEEN 0 AND 1) FROM m_weighted)",
                "both_labels_present": "(SELECT count(*) FROM pred WHERE actual_congestion_class IS NULL "
                "OR predicted_congestion_class IS NULL) = 0",
            }
        ),
        MATRIX_SQL,
        metrics_sql("matrix", "m"),
    ),
)
def split_quality(spark, sf_dir):
    return G.split_quality(
        observations(spark, sf_dir),
        F.lit("2000-01-01").cast("date"),
        _rule_metrics(spark, sf_dir),
        rule_predictions(spark, sf_dir, "obs_id"),
    )


@query(
    "G5_advisory_checks",
    over_observations(
        _checks_sql(
            {
                "input_row_count_equals_output_row_count": "(SELECT count(*) FROM adv) = (SELECT count(*) FROM orders)",
                "unique_key": f"(SELECT count(*) FROM ({_DUPLICATE_SQL})) = 0",
                "no_null_congestion_class": "(SELECT count(*) FROM adv WHERE congestion_class IS NULL) = 0",
                "valid_advisory_levels": "(SELECT count(*) FROM adv WHERE advisory_level NOT IN ('Normal', 'Moderate', 'High')) = 0",
                "one_level_per_congestion_class": "(SELECT count(DISTINCT (congestion_class, advisory_level)) "
                "= count(DISTINCT congestion_class) FROM adv)",
                "festival_context_rule": "(SELECT count(*) FROM adv WHERE festival_flag <> contains(notes, 'Festival-related traffic')) = 0",
                "holiday_context_rule": "(SELECT count(*) FROM adv WHERE holiday_flag <> contains(notes, 'Holiday-related traffic')) = 0",
                "roadwork_context_rule": "(SELECT count(*) FROM adv WHERE (roadwork = 'Yes') <> contains(notes, 'Roadwork is present')) = 0",
                "adverse_weather_context_rule": "(SELECT count(*) FROM adv WHERE (weather IN ('Rain', 'Fog')) "
                "<> contains(notes, 'Adverse weather is present')) = 0",
                "expected_output_columns": "true",
                "output_exists": "true",
            }
        ),
        ACTIONS_SQL,
        f"adv AS (SELECT *, {NOTES_SQL} AS notes FROM obs LEFT JOIN actions ON class = congestion_class)",
    ),
)
def advisory_checks(spark, sf_dir):
    """Of stored advisories, with the (date, corridor) key, which is not unique in these tables, so one check fails."""
    path = fresh_path(spark, "advisories")
    counted = G.write_observed(observations(spark, sf_dir), advise, path)
    stored = spark.read.parquet(path)
    return G.advisory_checks(counted["input_rows"], stored, ["date", "corridor"], G.output_exists(spark, path))


@query(
    "G6_predicted_advisory_checks",
    over_predictions(
        _checks_sql(
            {
                "test_rows_equal_prediction_rows": "true",
                "actual_and_predicted_columns_present": "true",
                "actual_and_predicted_values_supported": "(SELECT count(*) FROM test WHERE actual_congestion_class NOT IN "
                "('Low', 'Medium', 'High') OR predicted_congestion_class NOT IN ('Low', 'Medium', 'High')) = 0",
                "advice_uses_predicted_class_only": "true",
                "unique_key": "(SELECT count(*) FROM test) = (SELECT count(DISTINCT obs_id) FROM test)",
                "no_null_predicted_class": "(SELECT count(*) FROM test WHERE predicted_congestion_class IS NULL) = 0",
                "no_null_advisory_level": "(SELECT count(*) FROM test LEFT JOIN actions ON class = predicted_congestion_class "
                "WHERE advisory_level IS NULL) = 0",
                "advisory_levels_supported": "true",
                "test_period_exact": "(SELECT min(date) = (SELECT min(date) FROM dates WHERE date > (SELECT cutoff_date FROM cut)) "
                "AND max(date) = (SELECT max(date) FROM dates) FROM test)",
                "metrics_match_baseline": "true",
                "output_exists": "true",
            }
        ),
        ACTIONS_SQL,
        CUTOFF_SQL,
        "test AS (SELECT * FROM pred WHERE date > (SELECT cutoff_date FROM cut))",
    ),
)
def predicted_advisory_checks(spark, sf_dir):
    """Of stored advisories, against a stored specification's metrics and the split's own period."""
    carried = [n for n in S.PREDICTED_ADVISORY_COLUMNS[:11] if not n.endswith("congestion_class")]
    predictions = rule_predictions(spark, sf_dir, "obs_id", *carried)
    facts = observations(spark, sf_dir, "obs_id", "date")
    cutoff = cutoff_date(facts).select("cutoff_date").scalar()
    testing, tested = (split_at(data, cutoff)[1] for data in (facts, predictions))
    folder = fresh_path(spark, "prediction-run")
    G.write_observed(tested, lambda rows: advise_predictions(rows, "obs_id"), f"{folder}/advisories")
    measured = scoring.weighted_metrics(scoring.confusion_matrix(tested))
    values = F.map_from_entries(F.collect_list(F.struct("metric", "value")))
    measured.agg(F.to_json(F.struct(values.alias("evaluation")))).write.text(f"{folder}/specification")
    stored = spark.read.parquet(f"{folder}/advisories")
    document = reports.read_reports(spark, f"{folder}/specification")
    period = test_period(facts)
    return G.predicted_advisory_checks(
        testing,
        tested,
        stored,
        ["obs_id"],
        (period.select("first_date").scalar(), period.select("last_date").scalar()),
        scoring.weighted_metrics(scoring.confusion_matrix(stored)),
        reports.parse_spec_metrics(document, "report").select("metric", "value"),
        G.output_exists(spark, f"{folder}/advisories"),
    )


@query(
    "G7_chart_inputs",
    over_observations(
        _union(
            [
                f"SELECT '{name}' AS name, count(*) > 0 AS passed FROM obs {condition}"
                for name, condition in (
                    ("integrated", ""),
                    ("corridor_congestion_summary", ""),
                    ("day_type_congestion_summary", ""),
                    ("festival_congestion_summary", ""),
                    ("holiday_congestion_summary", ""),
                    ("day_of_week_congestion_summary", ""),
                    ("top5_average_congestion_corridors", ""),
                    ("top5_high_congestion_percentage_corridors", ""),
                    ("prediction_advisory", ""),
                )
            ]
            + ["SELECT 'advisory', false"]
        )
    ),
)
def chart_inputs(spark, sf_dir):
    """The advisory input is given without its level, so its check fails."""
    data = observations(spark, sf_dir)
    results = summarise_all(data)
    carried = [n for n in S.PREDICTED_ADVISORY_COLUMNS[:11] if not n.endswith("congestion_class")]
    predicted = advise_predictions(rule_predictions(spark, sf_dir, *carried))
    return G.chart_inputs(
        {"integrated": data, **results, "prediction_advisory": predicted, "advisory": advise(data).drop("advisory_level")}
    )
