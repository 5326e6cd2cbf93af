"""Registered queries: scans, sinks, reports, specifications, generated data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadgrain import schemas as S
from roadgrain.functions.derive import threshold_class
from roadgrain.operators import aggregates as A, gates, reporting, scoring, summaries
from roadgrain.operators.advisory import advise, apply_rules
from roadgrain.operators.shape import typed
from roadgrain.operators.split import cutoff_date, with_part
from roadgrain.plans.registry import (
    CALENDAR_SQL,
    over_observations,
    over_predictions,
    query,
    r4,
    rounded,
    sql_class,
    sql_r4,
)
from roadgrain.plans.shape_queries import CUTOFF_SQL
from roadgrain.plans.summary_queries import MATRIX_SQL, metrics_sql
from roadgrain.session import fresh_path
from roadgrain.sources import files, reports, synthetic
from roadgrain.sources.given import OBSERVATION_COLUMNS, calendar, observations, raw_observations, rule_predictions, table


# ------------------------------------------------------------------ scans and sinks
@query(
    "S1_raw_csv_scan",
    over_observations(
        "SELECT weather, count(*) AS row_count, count(*) FILTER (obs_id % 59 = 0) AS null_dates, "
        "count(*) FILTER (obs_id % 53 = 0) AS null_volumes, "
        f"{sql_r4('avg(CASE WHEN obs_id % 53 <> 0 THEN traffic_volume END)')} AS average_volume, "
        f"{sql_r4('avg(congestion_level)')} AS average_congestion, "
        "max(CASE WHEN obs_id % 59 <> 0 THEN date END) AS last_date FROM obs GROUP BY weather"
    ),
)
def raw_csv_scan(spark, sf_dir):
    """Writes the raw columns as CSV with unparseable cells, then scans them with the fixed schema."""
    raw, key = raw_observations(spark, sf_dir), F.col("obs_id")
    faults = {
        "Date": F.when(key % 59 == 0, "1999-13-45").otherwise(F.col("Date").cast("string")),
        "Traffic Volume": F.when(key % 53 == 0, "n/a").otherwise(F.col("`Traffic Volume`").cast("string")),
    }
    cells = raw.select(*[faults.get(name, F.col(f"`{name}`")).alias(name) for name in S.RAW_SCHEMA.names])
    path = files.write_stage(cells, fresh_path(spark, "raw"), [f"`{n}`" for n in S.RAW_SCHEMA.names], "csv")
    scanned = files.read_raw(spark, path)
    return scanned.groupBy(F.col("Weather Conditions").alias("weather")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("Date").isNull()).alias("null_dates"),
        F.count_if(F.col("Traffic Volume").isNull()).alias("null_volumes"),
        r4(F.avg("Traffic Volume")).alias("average_volume"),
        r4(F.avg("Congestion Level")).alias("average_congestion"),
        F.max("Date").alias("last_date"),
    )


_STAGE_SQL = over_observations(
    "SELECT congestion_class, count(*) AS row_count, min(date) AS first_date, max(date) AS last_date, "
    f"{sql_r4('avg(traffic_volume)')} AS average_volume, count(festival_name) AS named_rows FROM obs GROUP BY ALL"
)


def _stage_summary(data: DataFrame) -> DataFrame:
    return data.groupBy(S.TARGET).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        r4(F.avg("traffic_volume")).alias("average_volume"),
        F.count("festival_name").alias("named_rows"),
    )


@query("S2_stage_csv_scan", _STAGE_SQL)
def stage_csv_scan(spark, sf_dir):
    data = observations(spark, sf_dir, *S.INTEGRATED_COLUMNS)
    path = files.write_stage(data, fresh_path(spark, "stage"), S.INTEGRATED_COLUMNS, "csv")
    return _stage_summary(files.read_stage(spark, path, S.INTEGRATED_SCHEMA, "csv"))


@query(
    "S3_typed_columns",
    """SELECT o_orderkey AS obs_id, CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderdate AS DATE) END AS date,
         CASE WHEN o_orderkey % 11 > 0 THEN o_custkey + 0.5e0 END AS traffic_volume,
         CASE WHEN o_orderkey % 13 > 0 THEN CAST(o_custkey % 7 + 1 AS INTEGER) ELSE -1 END AS day_of_week,
         CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS festival_flag FROM orders""",
)
def typed_columns(spark, sf_dir):
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    cells = table(spark, sf_dir, "orders").select(
        key.alias("obs_id"),
        F.when(key % 7 == 0, "31/12/1999").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.when(key % 11 == 0, "many").otherwise(F.concat(customer, F.lit(".5"))).alias("traffic_volume"),
        F.when(key % 13 == 0, "").otherwise((customer % 7 + 1).cast("string")).alias("day_of_week"),
        F.when(key % 3 == 0, "true").when(key % 3 == 1, "False").otherwise("maybe").alias("festival_flag"),
    )
    return typed(cells, S.INTEGRATED_SCHEMA).fillna(-1, ["day_of_week"])


@query(
    "S4_calendar_scan",
    over_observations(
        "SELECT date, festival_name, festival_flag, holiday_flag, source FROM cal "
        "WHERE date IN (SELECT date FROM obs)"
    ),
)
def calendar_scan(spark, sf_dir):
    """The calendar of the dates that occur, written as CSV and scanned with its schema."""
    days = observations(spark, sf_dir, "date").distinct()
    used = calendar(spark, sf_dir).join(days, "date", "left_semi")
    path = files.write_stage(used, fresh_path(spark, "calendar"), S.CALENDAR_SCHEMA.names, "csv")
    return files.read_calendar(spark, path)


_KEY_TYPES = {"day_of_week": "int", "festival_flag": "boolean", "holiday_flag": "boolean"}


def _schema_text(name: str) -> str:
    summary = summaries.SUMMARIES[name]
    key_type = _KEY_TYPES.get(summary.key, "string")
    columns = [f"{summary.key}:{key_type}"]
    for column, kind in summary.columns.items():
        columns.append(f"{column}:{'double' if kind.startswith('avg') or kind == 'high%' else 'bigint'}")
    return f"struct<{','.join(columns)}>"


def _catalogue_sql() -> str:
    parts = []
    for name, summary in summaries.SUMMARIES.items():
        where = f"WHERE {summary.only}" if summary.only else ""
        count = f"(SELECT count(DISTINCT {summary.key}) FROM obs {where})"
        rows = f"least({count}, {summary.limit})" if summary.limit else count
        parts.append(
            f"SELECT '{name}' AS result, '{_schema_text(name)}' AS \"schema\", {rows} AS row_count, "
            f"CAST(least({rows}, 5) AS INTEGER) AS sample_count"
        )
    return over_observations(" UNION ALL ".join(parts))


@query("S5_output_catalogue", _catalogue_sql())
def output_catalogue(spark, sf_dir):
    results = summaries.summarise_all(observations(spark, sf_dir))
    return files.catalogue(results).select("result", "schema", "row_count", F.size("sample_rows").alias("sample_count"))


@query(
    "S5_sample_rows",
    over_observations(
        "SELECT corridor, total_records, high_congestion_count FROM (SELECT corridor, count(*) AS total_records, "
        "count(*) FILTER (congestion_class = 'High') AS high_congestion_count FROM obs GROUP BY corridor "
        "ORDER BY 100e0 * count(*) FILTER (congestion_class = 'High') / count(*) DESC, corridor LIMIT 5)"
    ),
)
def sample_rows(spark, sf_dir):
    name = "high_congestion_corridors"
    data = observations(spark, sf_dir, "corridor", *S.NUMERIC_MEASURES, S.TARGET)
    listed = files.catalogue({name: summaries.summarise(data, name)})
    row = F.from_json("row", "corridor string, total_records bigint, high_congestion_count bigint")
    return listed.select(F.explode("sample_rows").alias("row")).select(row.alias("r")).select("r.*")


@query(
    "S6_stage_sink",
    over_observations(
        "SELECT strftime(date, '%Y-%m') AS year_month, count(*) AS row_count, min(date) AS first_date, "
        "max(date) AS last_date, count(DISTINCT corridor) AS corridors FROM obs GROUP BY ALL"
    ),
)
def stage_sink(spark, sf_dir):
    """Written as Parquet with one folder per month; the folder name is read back as a column."""
    data = observations(spark, sf_dir, *S.INTEGRATED_COLUMNS)
    path = files.write_stage(data, fresh_path(spark, "months"), S.INTEGRATED_COLUMNS, by_month=True)
    return (
        spark.read.schema(S.STAGE_BY_MONTH_SCHEMA)
        .parquet(path)
        .groupBy("year_month")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            F.count_distinct("corridor").alias("corridors"),
        )
    )


@query(
    "S6_stage_date_range",
    over_observations(
        "SELECT corridor, count(*) AS row_count, min(date) AS first_date, max(date) AS last_date FROM obs "
        "WHERE date BETWEEN DATE '1996-02-10' AND DATE '1998-11-20' GROUP BY corridor"
    ),
)
def stage_date_range(spark, sf_dir):
    """A date range read back from month folders: only the folders in the range are opened."""
    data = observations(spark, sf_dir, *S.INTEGRATED_COLUMNS)
    path = files.write_stage(data, fresh_path(spark, "stage"), S.INTEGRATED_COLUMNS, by_month=True)
    some = files.read_stage(spark, path, S.INTEGRATED_SCHEMA, date_range=("1996-02-10", "1998-11-20"))
    return some.groupBy("corridor").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


@query("S6_stage_round_trip", _STAGE_SQL)
def stage_round_trip(spark, sf_dir):
    data = observations(spark, sf_dir, *S.INTEGRATED_COLUMNS)
    path = files.write_stage(data, fresh_path(spark, "stage"), S.INTEGRATED_COLUMNS, by_month=True)
    return _stage_summary(files.read_stage(spark, path, S.INTEGRATED_SCHEMA))


@query(
    "S7_named_view_sql",
    over_observations(
        f"SELECT area, day_type, count(*) AS record_count, {sql_r4('avg(congestion_level)')} AS average_congestion_level "
        "FROM obs WHERE roadwork = 'Yes' GROUP BY area, day_type ORDER BY area, day_type"
    ),
)
def named_view_sql(spark, sf_dir):
    summaries.register_view(observations(spark, sf_dir))
    return rounded(
        spark.sql(
            "SELECT area, day_type, count(*) AS record_count, avg(congestion_level) AS average_congestion_level "
            "FROM traffic_data WHERE roadwork = 'Yes' GROUP BY area, day_type ORDER BY area, day_type"
        )
    )


def _long_sql(section: str, one_row: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{name}' AS name, CAST({name} AS VARCHAR) AS value FROM ({one_row})" for name in names
    )


@query(
    "S8_run_report",
    over_predictions(
        _long_sql(
            "dataset",
            "SELECT count(*) AS total_rows, min(date) AS first_date, max(date) AS last_date, count(DISTINCT corridor) AS corridors FROM obs",
            ["total_rows", "first_date", "last_date", "corridors"],
        )
        + " UNION ALL "
        + _long_sql(
            "context",
            "SELECT count(*) FILTER (festival_flag) AS festival, count(*) FILTER (holiday_flag) AS holiday, "
            "count(*) FILTER (roadwork = 'Yes') AS roadwork, count(*) FILTER (weather IN ('Rain', 'Fog')) AS rain_or_fog FROM obs",
            ["festival", "holiday", "roadwork", "rain_or_fog"],
        )
        + " UNION ALL SELECT 'evaluation', metric, printf('%.6f', value) FROM m_weighted"
        + " UNION ALL SELECT 'confusion matrix', actual_class || ',' || predicted_class, CAST(count AS VARCHAR) FROM matrix",
        MATRIX_SQL,
        metrics_sql("matrix", "m"),
    ),
)
def run_report(spark, sf_dir):
    data = observations(spark, sf_dir, "date", "corridor", "festival_flag", "holiday_flag", "roadwork", "weather")
    dataset = data.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_distinct("corridor").alias("corridors"),
    )
    matrix = scoring.confusion_matrix(rule_predictions(spark, sf_dir))
    metrics = scoring.weighted_metrics(matrix)
    return (
        files.report_rows(dataset, "dataset")
        .unionByName(files.report_rows(A.context_counts(data), "context"))
        .unionByName(
            metrics.select(
                F.lit("evaluation").alias("section"),
                F.col("metric").alias("name"),
                F.format_string("%.6f", "value").alias("value"),
            )
        )
        .unionByName(
            matrix.select(
                F.lit("confusion matrix").alias("section"),
                F.concat_ws(",", "actual_class", "predicted_class").alias("name"),
                F.col("count").cast("string").alias("value"),
            )
        )
    )


def _scored(spark, sf_dir, *columns: str) -> DataFrame:
    """Observations with their part (P8's cutoff) and the rule's prediction; the other columns as asked."""
    facts = observations(spark, sf_dir, "date", "traffic_volume", S.TARGET, *[c for c in columns if c not in ("date", "traffic_volume")])
    cutoff = cutoff_date(observations(spark, sf_dir, "date")).select("cutoff_date").scalar()
    classes = {
        reporting.ACTUAL: F.col(S.TARGET),
        reporting.PREDICTED: threshold_class(F.col("traffic_volume") / 5000.0),
    }
    return with_part(facts.withColumns(classes), cutoff)


def _store(name: str):
    return lambda data: files.stored(data, name)


_PARTED_SQL = (
    f"{CUTOFF_SQL}, s AS (SELECT *, CASE WHEN date <= (SELECT cutoff_date FROM cut) THEN 'training' ELSE 'testing' END AS part FROM pred), "
    "tested AS (SELECT * FROM s WHERE part = 'testing'), "
    "matrix AS (SELECT actual_congestion_class AS actual_class, predicted_congestion_class AS predicted_class, count(*) AS count "
    "FROM tested GROUP BY ALL)"
)
_PART_LINES_SQL = (
    "SELECT 'dataset' AS section, part || ' rows' AS name, CAST(count(*) AS VARCHAR) AS value FROM s GROUP BY part "
    "UNION ALL SELECT 'dataset', part || ' first date', CAST(min(date) AS VARCHAR) FROM s GROUP BY part "
    "UNION ALL SELECT 'dataset', part || ' last date', CAST(max(date) AS VARCHAR) FROM s GROUP BY part "
    "UNION ALL SELECT 'dataset', 'total rows', CAST(count(*) AS VARCHAR) FROM s"
)
_EVALUATION_SQL = "UNION ALL SELECT 'evaluation', metric, printf('%.6f', value) FROM m_weighted"
_CELLS_SQL = "UNION ALL SELECT 'confusion matrix', actual_class || ',' || predicted_class, CAST(count AS VARCHAR) FROM "


def _context_lines_sql(rows: str) -> str:
    counts = {
        "festival": "festival_flag",
        "holiday": "holiday_flag",
        "roadwork": "roadwork = 'Yes'",
        "rain_or_fog": "weather IN ('Rain', 'Fog')",
    }
    return " ".join(
        f"UNION ALL SELECT 'context', '{name}', CAST(count(*) FILTER ({condition}) AS VARCHAR) FROM {rows}"
        for name, condition in counts.items()
    )


@query(
    "S8_training_report",
    over_predictions(
        f"""{_PART_LINES_SQL} UNION ALL SELECT 'class distribution', part || ' ' || congestion_class,
          printf('count=%d, percentage=%.4f%%', count(*), 100e0 * count(*) / any_value(n))
          FROM s JOIN (SELECT part, count(*) AS n FROM s GROUP BY part) USING (part) GROUP BY part, congestion_class
        {_EVALUATION_SQL} {_CELLS_SQL} matrix UNION ALL SELECT 'quality', part || ' rows with a null feature',
          CAST(count(*) FILTER ({" OR ".join(f"{c} IS NULL" for c in S.FEATURES)}) AS VARCHAR) FROM s GROUP BY part
        UNION ALL SELECT 'quality', 'training before testing', CASE WHEN max(date) FILTER (part = 'training')
          < min(date) FILTER (part = 'testing') THEN 'PASS' ELSE 'FAIL' END FROM s""",
        _PARTED_SQL,
        metrics_sql("matrix", "m"),
    ),
)
def training_report(spark, sf_dir):
    return reporting.training_report(_scored(spark, sf_dir, *S.FEATURES), _store("training-report"))


@query(
    "S8_benchmark_report",
    over_predictions(
        f"{_PART_LINES_SQL} UNION ALL SELECT 'volume rule', metric, printf('%.6f', value) FROM m_weighted "
        f"UNION ALL SELECT 'blended rule', metric, printf('%.6f', value) FROM n_weighted {_CELLS_SQL} matrix2",
        _PARTED_SQL,
        f"matrix2 AS (SELECT congestion_class AS actual_class, {sql_class('((traffic_volume / 5000e0 + congestion_level) / 2e0)')} "
        "AS predicted_class, count(*) AS count FROM tested GROUP BY ALL)",
        metrics_sql("matrix", "m"),
        metrics_sql("matrix2", "n"),
    ),
)
def benchmark_report(spark, sf_dir):
    blend = threshold_class((F.col("traffic_volume") / 5000.0 + F.col("congestion_level")) / 2.0)
    scored = _scored(spark, sf_dir, "congestion_level").withColumn("blended", blend)
    models = {"volume rule": reporting.PREDICTED, "blended rule": "blended"}
    return reporting.benchmark_report(scored, models, _store("benchmark-report"))


_LEVEL_SQL = "CASE {} WHEN 'Low' THEN 'Normal' WHEN 'Medium' THEN 'Moderate' ELSE 'High' END"


@query(
    "S8_advisory_report",
    over_observations(
        "SELECT 'dataset' AS section, 'total advisories' AS name, CAST(count(*) AS VARCHAR) AS value FROM obs "
        f"UNION ALL SELECT 'advisory level', {_LEVEL_SQL.format('congestion_class')}, CAST(count(*) AS VARCHAR) FROM obs GROUP BY congestion_class "
        "UNION ALL SELECT 'congestion class', congestion_class, CAST(count(*) AS VARCHAR) FROM obs GROUP BY congestion_class "
        f"{_context_lines_sql('obs')} UNION ALL SELECT 'validation', 'rows_kept', CASE WHEN (SELECT count(*) FROM obs) "
        "= (SELECT count(*) FROM orders) THEN 'PASS' ELSE 'FAIL' END"
    ),
)
def advisory_report(spark, sf_dir):
    """Of stored advisories, with the check that every observation, counted while it passed, has one."""
    path = fresh_path(spark, "advisories")
    counted = gates.write_observed(observations(spark, sf_dir), advise, path)
    stored = spark.read.parquet(path)
    checks = gates.rows_kept(counted["input_rows"], stored)
    return reporting.advisory_report(stored, _store("advisory-report"), checks)


@query(
    "S8_prediction_report",
    over_predictions(
        f"{_PART_LINES_SQL} UNION ALL SELECT 'predictions', predicted_congestion_class, CAST(count(*) AS VARCHAR) FROM tested "
        f"GROUP BY predicted_congestion_class {_EVALUATION_SQL} {_CELLS_SQL} matrix UNION ALL SELECT 'advisory level', "
        f"{_LEVEL_SQL.format('predicted_congestion_class')}, CAST(count(*) AS VARCHAR) FROM tested GROUP BY predicted_congestion_class "
        f"{_context_lines_sql('tested')}",
        _PARTED_SQL,
        metrics_sql("matrix", "m"),
    ),
)
def prediction_report(spark, sf_dir):
    scored = _scored(spark, sf_dir, "festival_flag", "holiday_flag", "roadwork", "weather")
    advised = apply_rules(scored, reporting.PREDICTED)
    return reporting.prediction_report(advised, _store("prediction-report"))


def _feature_report_sql() -> str:
    features = [*S.CATEGORICAL_FEATURES, "day_of_week", *S.BOOLEAN_FEATURES]
    lines = [("dataset", "rows", "count(*)"), ("dataset", "first date", "min(date)"), ("dataset", "last date", "max(date)")]
    lines += [
        ("target", c, f"printf('count=%d, percentage=%.4f%%', count(*) FILTER ({S.TARGET} = '{c}'), "
         f"100e0 * count(*) FILTER ({S.TARGET} = '{c}') / count(*))")
        for c in S.CLASSES
    ]
    lines += [("distinct values", c, f"count(DISTINCT {c})") for c in features]
    lines += [("null counts", c, f"count(*) FILTER ({c} IS NULL)") for c in [*features, *S.NUMERIC_MEASURES]]
    for c in S.NUMERIC_MEASURES:
        lines.append(("numeric summary", f"{c} count", f"count({c})"))
        for name, function in (("min", "min"), ("max", "max"), ("mean", "avg")):
            lines.append(("numeric summary", f"{c} {name}", f"printf('%.3f', {function}({c}) + 1e-7)"))
    parts = [f"SELECT '{s}' AS section, '{n}' AS name, CAST({v} AS VARCHAR) AS value FROM obs" for s, n, v in lines]
    parts += [f"SELECT 'excluded', '{c}', '{why}'" for c, why in S.EXCLUDED_FEATURES.items()]
    parts += [f"SELECT 'unavailable', '{c}', ''" for c in S.UNAVAILABLE_FEATURES]
    return " UNION ALL ".join(parts)


@query("S8_feature_report", over_observations(_feature_report_sql()))
def feature_report(spark, sf_dir):
    return reporting.feature_report(observations(spark, sf_dir, *S.INTEGRATED_COLUMNS), _store("feature-report"))


@query(
    "S11_file_fingerprint",
    """WITH y AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS y, string_agg(o_orderkey || ',' || o_custkey, chr(10) ORDER BY o_orderkey) || chr(10)
         AS content FROM orders GROUP BY 1)
       SELECT y AS year, CAST(length(content) AS BIGINT) AS length, sha256(content) AS sha256 FROM y""",
)
def file_fingerprint(spark, sf_dir):
    """Digests of the bytes of text files, one for the orders of each year, that are written from the table first."""
    path = fresh_path(spark, "years")
    lines = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("y"), "o_orderkey", F.concat_ws(",", "o_orderkey", "o_custkey").alias("line")
    )
    dealt = lines.repartition("y").sortWithinPartitions("y", "o_orderkey")
    dealt.select("y", "line").write.partitionBy("y").text(path)
    year = F.regexp_extract("file", r"y=(\d+)", 1)
    return files.file_digests(spark, path).where("length > 0").select(year.alias("year"), "length", "sha256")


# ---------------------------------------------------------------- text reports
def _shares(spark, sf_dir) -> DataFrame:
    """Four shares in [0, 1] per corridor, and the number in its road name."""
    rows = rule_predictions(spark, sf_dir, "corridor", "road_intersection")
    same = F.col("actual_congestion_class") == F.col("predicted_congestion_class")
    n = F.count(F.lit(1))
    return rows.groupBy("corridor").agg(
        (F.count_if(same) / n).alias("a"),
        (F.count_if(F.col("predicted_congestion_class") == "Low") / n).alias("b"),
        (F.count_if(F.col("actual_congestion_class") == "Low") / n).alias("c"),
        (F.count_if(F.col("actual_congestion_class") == "High") / n).alias("d"),
        F.max(F.regexp_extract("road_intersection", r"(\d+)", 1).cast("int")).alias("k"),
    )


_SHARES_SQL = (
    "shares AS (SELECT corridor, count(*) FILTER (actual_congestion_class = predicted_congestion_class) / count(*)::DOUBLE AS a, "
    "count(*) FILTER (predicted_congestion_class = 'Low') / count(*)::DOUBLE AS b, "
    "count(*) FILTER (actual_congestion_class = 'Low') / count(*)::DOUBLE AS c, "
    "count(*) FILTER (actual_congestion_class = 'High') / count(*)::DOUBLE AS d, "
    "max(CAST(regexp_extract(road_intersection, '(\\d+)', 1) AS INTEGER)) AS k FROM pred GROUP BY corridor)"
)


@query(
    "S9_report_metrics",
    over_predictions(
        """SELECT corridor, 'Accuracy' AS metric, CASE k % 5 WHEN 2 THEN NULL WHEN 3 THEN 1.5e0
             ELSE CAST(printf('%.6f', a) AS DOUBLE) END AS value,
             CASE k % 5 WHEN 2 THEN 'not numeric: 0.9.1' WHEN 3 THEN 'outside [0, 1]' END AS problem FROM shares
           UNION ALL SELECT corridor, 'Weighted Precision', CAST(printf('%.6f', b) AS DOUBLE), NULL FROM shares
           UNION ALL SELECT corridor, 'Weighted Recall', CAST(printf('%.6f', c) AS DOUBLE), NULL FROM shares
           UNION ALL SELECT corridor, 'F1', CASE WHEN k % 5 <> 1 THEN CAST(printf('%.6f', d) AS DOUBLE) END,
             CASE WHEN k % 5 = 1 THEN 'missing' END FROM shares""",
        _SHARES_SQL,
    ),
)
def report_metrics(spark, sf_dir):
    """One text report per corridor, some with a broken or absent metric."""
    fault = F.col("k") % 5
    accuracy = F.when(fault == 2, "0.9.1").when(fault == 3, "1.500000").otherwise(F.format_string("%.6f", "a"))
    f1_label = F.when(fault == 4, "F1: ").otherwise("F1 Score: ")
    text = F.concat_ws(
        "\n",
        F.lit("MODEL REPORT"),
        F.concat(F.lit("Accuracy: "), accuracy),
        F.format_string("Weighted Precision: %.6f", "b"),
        F.format_string("Weighted Recall:   %.6f", "c"),
        F.when(fault != 1, F.concat(f1_label, F.format_string("%.6f", "d"))),
        F.lit("end"),
    )
    return reports.parse_metrics(_shares(spark, sf_dir).select("corridor", text.alias("text")), "corridor")


@query(
    "S10_report_matrices",
    over_predictions(
        "SELECT corridor, CAST(position AS INTEGER) AS position, k.c AS actual_class, "
        + ", ".join(
            f"count(*) FILTER (actual_congestion_class = k.c AND predicted_congestion_class = '{c}') AS \"{c}\""
            for c in S.CLASSES_ALPHABETIC
        )
        + ", CAST(NULL AS VARCHAR) AS problem FROM pred, (VALUES (1, 'High'), (2, 'Low'), (3, 'Medium')) k(position, c) "
        "WHERE length(corridor) % 5 NOT IN (1, 2) GROUP BY ALL "
        "UNION ALL SELECT DISTINCT corridor, NULL, NULL, NULL, NULL, NULL, "
        "CASE length(corridor) % 5 WHEN 1 THEN 'missing' ELSE 'empty' END FROM pred WHERE length(corridor) % 5 IN (1, 2)"
    ),
)
def report_matrices(spark, sf_dir):
    """One text report per corridor holding its confusion block; at most nine lines each.

    Some reports have no block, some an empty one, and all have a second block after
    the first, which is not part of the matrix.
    """
    cells = (
        rule_predictions(spark, sf_dir, "corridor")
        .groupBy("corridor", "actual_congestion_class", "predicted_congestion_class")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    line = F.concat_ws(",", "actual_congestion_class", "predicted_congestion_class", F.col("n").cast("string"))
    lines = F.array_join(F.array_sort(F.collect_list(line)), "\n")
    fault = F.length("corridor") % 5
    text = F.concat(
        F.lit("REPORT\n\n"),
        F.when(fault == 1, "").otherwise(F.concat(F.lit(reports.MATRIX_HEADER + "\n"), F.when(fault == 2, "").otherwise(lines))),
        F.lit("\n\nFeature importances\ntraffic_volume 0.5\n"),
        F.when(fault == 1, "").otherwise(F.lit(reports.MATRIX_HEADER + "\nHigh,High,7\n")),
    )
    return reports.parse_matrices(cells.groupBy("corridor").agg(text.alias("text")), "corridor")


# Measures are printed as ten-thousandths, because engines write doubles differently.
_MEASURES = ["traffic_volume", "average_speed", "travel_time_index", "congestion_level"]
_PRINT_TYPES = {
    name: {"obs_id": "bigint", "date": "date", "day_of_week": "int", "festival_flag": "boolean", "holiday_flag": "boolean"}.get(
        name, "bigint" if name in _MEASURES else "string"
    )
    for name in OBSERVATION_COLUMNS
}


def _printed_sql(name: str) -> str:
    if name in _MEASURES:
        return f"CAST(CAST(floor({name} * 10000e0 + 0.5e0) AS BIGINT) AS VARCHAR)"
    return f"CAST({name} AS VARCHAR)"


@query(
    "S11_table_fingerprint",
    over_observations(
        "SELECT count(*) AS row_count, CAST(sum(('0x' || substr(h, 1, 15))::BIGINT) AS VARCHAR) AS digest_low, "
        "CAST(sum(('0x' || substr(h, 16, 15))::BIGINT) AS VARCHAR) AS digest_high FROM (SELECT md5(concat_ws('|', '"
        + ", ".join(f"{name} {kind}" for name, kind in _PRINT_TYPES.items())
        + "', "
        + ", ".join(f"coalesce(length({_printed_sql(n)}) || ':' || {_printed_sql(n)}, 'n')" for n in _PRINT_TYPES)
        + ")) AS h FROM obs)"
    ),
)
def table_fingerprint(spark, sf_dir):
    """All columns of the observations."""
    scaled = {name: F.floor(F.col(name) * 10000.0 + 0.5).cast("bigint") for name in _MEASURES}
    return files.fingerprint(observations(spark, sf_dir).withColumns(scaled))


@query(
    "S14_specification_metrics",
    over_predictions(
        """SELECT corridor, 'Accuracy' AS metric, CASE k % 5 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN -0.25e0 ELSE a END AS value,
             CASE k % 5 WHEN 1 THEN 'missing' WHEN 2 THEN 'not numeric: high' WHEN 3 THEN 'outside [0, 1]' END AS problem FROM shares
           UNION ALL SELECT corridor, 'Weighted Precision', b, NULL FROM shares
           UNION ALL SELECT corridor, 'Weighted Recall', c, NULL FROM shares
           UNION ALL SELECT corridor, 'F1 Score', d, NULL FROM shares""",
        _SHARES_SQL,
    ),
)
def specification_metrics(spark, sf_dir):
    fault, shares = F.col("k") % 5, _shares(spark, sf_dir)
    accuracy = (
        F.when(fault == 1, F.lit(None)).when(fault == 2, "high").when(fault == 3, "-0.25").otherwise(F.col("a").cast("string"))
    )
    values = F.struct(
        accuracy.alias("Accuracy"),
        F.col("b").alias("Weighted Precision"),
        F.col("c").alias("Weighted Recall"),
        F.col("d").alias("F1 Score"),
    )
    documents = shares.select("corridor", F.to_json(F.struct(values.alias("evaluation"))).alias("text"))
    return reports.parse_spec_metrics(documents, "corridor")


def _importance_faults_sql() -> str:
    parts = []
    for i, name in enumerate(S.FEATURES):
        value, problem = f"v{i}", "NULL"
        if i == 0:
            value, problem = f"CASE WHEN k % 5 = 1 THEN -v{i} ELSE v{i} END", f"CASE WHEN k % 5 = 1 AND v{i} > 0 THEN 'negative' END"
        if name == "weather":
            value, problem = f"CASE WHEN k % 5 <> 2 THEN v{i} END", "CASE WHEN k % 5 = 2 THEN 'missing' END"
        if name == "area":
            value, problem = f"CASE WHEN k % 5 <> 3 THEN v{i} END", "CASE WHEN k % 5 = 3 THEN 'not numeric' END"
        parts.append(f"SELECT corridor, '{name}' AS feature_group, {value} AS importance, {problem} AS problem FROM parts")
    return " UNION ALL ".join(parts)


@query(
    "S15_specification_importances",
    over_observations(
        f"SELECT *, CASE WHEN abs(sum(importance) OVER (PARTITION BY corridor) - 1) > 0.01 THEN 'total is not 1' END "
        f"AS total_problem FROM ({_importance_faults_sql()})",
        "parts AS (SELECT corridor, max(CAST(regexp_extract(road_intersection, '(\\d+)', 1) AS INTEGER)) AS k, "
        + ", ".join(f"count(*) FILTER (obs_id % 12 = {i}) / count(*)::DOUBLE AS v{i}" for i in range(12))
        + " FROM obs GROUP BY corridor)",
    ),
)
def specification_importances(spark, sf_dir):
    """One specification per corridor whose twelve shares add up to one, some with a fault."""
    rows = observations(spark, sf_dir, "obs_id", "corridor", "road_intersection")
    shares = rows.groupBy("corridor").agg(
        F.max(F.regexp_extract("road_intersection", r"(\d+)", 1).cast("int")).alias("k"),
        *[(F.count_if(F.col("obs_id") % 12 == i) / F.count(F.lit(1))).alias(f"v{i}") for i in range(12)],
    )
    fault = F.col("k") % 5
    cells = []
    for i, name in enumerate(S.FEATURES):
        value = F.col(f"v{i}").cast("string")
        if i == 0:
            value = F.when(fault == 1, F.concat(F.lit("-"), value)).otherwise(value)
        if name == "weather":
            value = F.when(fault != 2, value)
        if name == "area":
            value = F.when(fault == 3, "abc").otherwise(value)
        cells.append(value.alias(name))
    documents = shares.select(
        "corridor", F.to_json(F.struct(F.struct(*cells).alias("grouped_feature_importances"))).alias("text")
    )
    return reports.parse_importances(documents, "corridor")


# --------------------------------------------------------------- generated data
_SPINE_SQL = (
    "spine AS (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), "
    "(SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS date)"
)


def _spine(spark, sf_dir) -> DataFrame:
    limits = observations(spark, sf_dir, "date").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return synthetic.date_spine(limits)


@query(
    "S16_date_spine",
    f"WITH {_SPINE_SQL} SELECT date, date IN (SELECT CAST(o_orderdate AS DATE) FROM orders) AS observed FROM spine",
)
def date_spine(spark, sf_dir):
    observed = observations(spark, sf_dir, "date").distinct().withColumn("observed", F.lit(True))
    return (
        _spine(spark, sf_dir)
        .join(observed, "date", "left")
        .select("date", F.coalesce("observed", F.lit(False)).alias("observed"))
    )


_SYNTHETIC_CALENDAR_SQL = (
    f"{CALENDAR_SQL}, {_SPINE_SQL}, hol AS (SELECT date FROM cal WHERE holiday_flag), "
    "scal AS (SELECT s.date, coalesce(f.festival_name, 'None') AS festival_name, f.date IS NOT NULL AS is_festival, "
    "s.date IN (SELECT date FROM hol) AS is_holiday, CASE WHEN f.date IS NOT NULL THEN 'Festival Day' "
    "WHEN s.date + 1 IN (SELECT date FROM hol) THEN 'Pre-Holiday' WHEN s.date - 1 IN (SELECT date FROM hol) THEN 'Post-Holiday' "
    "WHEN dayofweek(s.date) = 5 THEN 'Friday Evening' ELSE 'Normal Day' END AS day_type "
    "FROM spine s LEFT JOIN (SELECT * FROM cal WHERE festival_flag) f ON s.date = f.date)"
)


def _synthetic_calendar(spark, sf_dir) -> DataFrame:
    template = calendar(spark, sf_dir)
    return synthetic.synthetic_calendar(
        _spine(spark, sf_dir), template.where("festival_flag"), template.where("holiday_flag")
    )


@query("S17_synthetic_calendar", f"WITH {_SYNTHETIC_CALENDAR_SQL} SELECT * FROM scal")
def synthetic_calendar(spark, sf_dir):
    return _synthetic_calendar(spark, sf_dir)
