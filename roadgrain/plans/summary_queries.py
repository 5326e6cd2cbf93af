"""Registered queries: named summaries, distributions, key figures, comparisons, sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadgrain import schemas as S
from roadgrain.functions.derive import percentage, threshold_class
from roadgrain.operators import aggregates as A, scoring, shape, summaries
from roadgrain.operators.advisory import (
    add_context_notes,
    advise,
    advise_predictions,
    advise_predictions_by_key,
    apply_rules,
    corridor_rollup,
)
from roadgrain.plans.registry import (
    ACTIONS_SQL,
    NOTES_SQL,
    over_observations,
    over_predictions,
    query,
    rounded,
    sql_class,
    sql_r4,
)
from roadgrain.sources.given import observations, rule_predictions

_HI = "100e0 * count(*) FILTER (congestion_class = 'High') / count(*)"
_SQL_OF = {
    "rows": "count(*)",
    "low": "count(*) FILTER (congestion_class = 'Low')",
    "medium": "count(*) FILTER (congestion_class = 'Medium')",
    "high": "count(*) FILTER (congestion_class = 'High')",
    "high%": sql_r4(_HI),
}


def _summary_sql(name: str) -> str:
    summary = summaries.SUMMARIES[name]
    columns = [
        f"{sql_r4('avg(' + kind[4:] + ')') if kind.startswith('avg:') else _SQL_OF[kind]} AS {column}"
        for column, kind in summary.columns.items()
    ]
    unrounded = {
        "high_congestion_percentage": _HI,
        "average_congestion_level": "avg(congestion_level)",
        "average_festival_congestion_level": "avg(congestion_level)",
    }
    order = [
        f"{unrounded.get(column, column)} {'ASC' if ascending else 'DESC'}" for column, ascending in summary.order
    ]
    return over_observations(
        f"SELECT {summary.key}, {', '.join(columns)} FROM obs {'WHERE ' + summary.only if summary.only else ''} "
        f"GROUP BY {summary.key} ORDER BY {', '.join([*order, summary.key])} "
        f"{'LIMIT ' + str(summary.limit) if summary.limit else ''}"
    )


def _register_summary(number: int, name: str) -> None:
    summary = summaries.SUMMARIES[name]
    needed = {kind[4:] for kind in summary.columns.values() if kind.startswith("avg:")}
    columns = [summary.key, S.TARGET, *sorted(needed), *([summary.only] if summary.only else [])]
    # Measures that are not shown still appear in the partial aggregates, but Spark prunes them.
    columns = list(dict.fromkeys([*columns, *S.NUMERIC_MEASURES]))

    @query(f"Q{number}_{name}", _summary_sql(name))
    def run(spark, sf_dir):
        return rounded(summaries.summarise(observations(spark, sf_dir, *columns), name))


for _number, _name in enumerate(summaries.SUMMARIES, start=1):
    _register_summary(_number, _name)


@query(
    "A1_class_distribution",
    over_observations(
        "SELECT d.c AS class, count(obs.obs_id) AS count, "
        f"{sql_r4('100e0 * count(obs.obs_id) / (SELECT count(*) FROM obs)')} AS percentage "
        "FROM (VALUES ('Low'), ('Medium'), ('High')) d(c) LEFT JOIN obs ON congestion_class = d.c GROUP BY d.c"
    ),
)
def class_distribution(spark, sf_dir):
    return rounded(A.class_distribution(observations(spark, sf_dir, S.TARGET)))


@query(
    "A2_value_distribution",
    over_observations("SELECT corridor, count(*) AS count FROM obs GROUP BY corridor ORDER BY corridor"),
)
def value_distribution(spark, sf_dir):
    return A.distribution(observations(spark, sf_dir, "corridor"), "corridor")


MATRIX_SQL = (
    "matrix AS (SELECT actual_congestion_class AS actual_class, predicted_congestion_class AS predicted_class, "
    "count(*) AS count FROM pred GROUP BY ALL)"
)
_CLASS_LIST = "(VALUES (1, 'High'), (2, 'Low'), (3, 'Medium')) k(position, c)"


def metrics_sql(matrix: str, name: str) -> str:
    """Named parts ``{name}_totals`` and ``{name}_classes`` over a matrix table."""
    return (
        f"{name}_totals AS (SELECT position, c, "
        f"coalesce((SELECT sum(count) FROM {matrix} WHERE actual_class = c AND predicted_class = c), 0)::DOUBLE AS hit, "
        f"coalesce((SELECT sum(count) FROM {matrix} WHERE predicted_class = c), 0)::DOUBLE AS said, "
        f"coalesce((SELECT sum(count) FROM {matrix} WHERE actual_class = c), 0)::DOUBLE AS support FROM {_CLASS_LIST}), "
        f"{name}_scores AS (SELECT *, CASE WHEN said > 0 THEN hit / said ELSE 0e0 END AS p, "
        f"CASE WHEN support > 0 THEN hit / support ELSE 0e0 END AS r FROM {name}_totals), "
        f"{name}_classes AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0e0 END AS f FROM {name}_scores), "
        f"{name}_weighted AS (SELECT unnest(['Accuracy', 'Weighted Precision', 'Weighted Recall', 'F1 Score']) AS metric, "
        f"unnest([sum(hit) / sum(support), sum(p * support) / sum(support), sum(r * support) / sum(support), "
        f"sum(f * support) / sum(support)]) AS value FROM {name}_classes)"
    )


def _second_rule(spark, sf_dir):
    data = observations(spark, sf_dir, S.TARGET, "traffic_volume", "congestion_level")
    blend = (F.col("traffic_volume") / 5000.0 + F.col("congestion_level")) / 2.0
    return data.select(
        F.col(S.TARGET).alias("actual_congestion_class"), threshold_class(blend).alias("predicted_congestion_class")
    )


_SECOND_SQL = (
    "pred2 AS (SELECT congestion_class AS actual_class, "
    f"{sql_class('((traffic_volume / 5000e0 + congestion_level) / 2e0)')} AS predicted_class FROM obs), "
    "matrix2 AS (SELECT actual_class, predicted_class, count(*) AS count FROM pred2 GROUP BY ALL)"
)


def _matrix(spark, sf_dir):
    return scoring.confusion_matrix(rule_predictions(spark, sf_dir))


@query("A3_confusion_matrix", over_predictions("SELECT * FROM matrix", MATRIX_SQL))
def confusion_matrix(spark, sf_dir):
    return _matrix(spark, sf_dir)


@query(
    "A4_confusion_matrix_dense",
    over_predictions(
        "SELECT CAST(position AS INTEGER) AS position, k.c AS actual_class, "
        + ", ".join(
            f"CAST(coalesce(sum(count) FILTER (predicted_class = '{c}'), 0) AS BIGINT) AS \"{c}\"" for c in S.CLASSES
        )
        + " FROM (VALUES (1, 'Low'), (2, 'Medium'), (3, 'High')) k(position, c) "
        "LEFT JOIN matrix ON actual_class = k.c GROUP BY ALL",
        MATRIX_SQL,
    ),
)
def confusion_matrix_dense(spark, sf_dir):
    return scoring.dense_matrix(_matrix(spark, sf_dir))


@query(
    "A5_class_metrics",
    over_predictions(
        f"SELECT CAST(position AS INTEGER) AS position, c AS class, {sql_r4('p')} AS precision, {sql_r4('r')} AS recall, "
        f"{sql_r4('f')} AS f1, CAST(support AS BIGINT) AS support FROM m_classes",
        MATRIX_SQL,
        metrics_sql("matrix", "m"),
    ),
)
def class_metrics(spark, sf_dir):
    return rounded(scoring.class_metrics(_matrix(spark, sf_dir)))


@query(
    "A6_weighted_metrics",
    over_predictions(
        f"SELECT metric, {sql_r4('value')} AS value FROM m_weighted", MATRIX_SQL, metrics_sql("matrix", "m")
    ),
)
def weighted_metrics(spark, sf_dir):
    return rounded(scoring.weighted_metrics(_matrix(spark, sf_dir)))


@query(
    "A7_model_comparison",
    over_predictions(
        f"SELECT a.metric, {sql_r4('a.value')} AS volume_rule, {sql_r4('b.value')} AS blended_rule "
        "FROM m_weighted a JOIN n_weighted b ON a.metric = b.metric",
        MATRIX_SQL,
        _SECOND_SQL,
        metrics_sql("matrix", "m"),
        metrics_sql("matrix2", "n"),
    ),
)
def model_comparison(spark, sf_dir):
    second = scoring.confusion_matrix(_second_rule(spark, sf_dir))
    return rounded(
        scoring.compare_models(
            {
                "volume_rule": scoring.weighted_metrics(_matrix(spark, sf_dir)),
                "blended_rule": scoring.weighted_metrics(second),
            }
        )
    )


_PER_CLASS_SQL = (
    "SELECT c AS class, '{model}' AS model, {p} AS precision, {r} AS recall, {f} AS f1, "
    "CAST(support AS BIGINT) AS support FROM {name}_classes"
)


def _per_class_sql(model: str, name: str) -> str:
    return _PER_CLASS_SQL.format(model=model, name=name, p=sql_r4("p"), r=sql_r4("r"), f=sql_r4("f"))


_TWO_MODELS_SQL = over_predictions(
    _per_class_sql("volume rule", "m") + " UNION ALL " + _per_class_sql("blended rule", "n"),
    MATRIX_SQL,
    _SECOND_SQL,
    metrics_sql("matrix", "m"),
    metrics_sql("matrix2", "n"),
)


@query("A8_class_comparison", _TWO_MODELS_SQL)
def class_comparison(spark, sf_dir):
    second = scoring.confusion_matrix(_second_rule(spark, sf_dir))
    return rounded(
        scoring.compare_classes(
            {
                "volume rule": scoring.class_metrics(_matrix(spark, sf_dir)),
                "blended rule": scoring.class_metrics(second),
            }
        )
    )


@query(
    "A10_key_figures",
    over_observations(
        f"SELECT count(*) AS record_count, {sql_r4('avg(congestion_level)')} AS average_congestion_level, "
        f"{_SQL_OF['high']} AS high_congestion_count, {_SQL_OF['high%']} AS high_congestion_percentage, "
        "count(DISTINCT corridor) AS corridor_count FROM obs"
    ),
)
def key_figures(spark, sf_dir):
    return rounded(A.key_figures(observations(spark, sf_dir, S.TARGET, "congestion_level", "corridor")))


_SCENARIO = {"weather": "Rain", "roadwork": "Yes", "day_type": "Weekday"}
_SCENARIO_SQL = "weather = 'Rain' AND roadwork = 'Yes' AND day_type = 'Weekday'"


def _comparison_sql(predicate: str) -> str:
    measures = {
        "average_congestion_level": "congestion_level",
        "average_speed": "average_speed",
        "average_traffic_volume": "traffic_volume",
        "average_travel_time_index": "travel_time_index",
        "high_congestion_percentage": "CASE WHEN congestion_class = 'High' THEN 100e0 ELSE 0e0 END",
    }
    parts = [
        f"SELECT 'record_count' AS metric, count(*) FILTER ({predicate})::DOUBLE AS s, count(*)::DOUBLE AS b FROM obs"
    ]
    parts += [
        f"SELECT '{name}', avg({value}) FILTER ({predicate}), avg({value}) FROM obs" for name, value in measures.items()
    ]
    return over_observations(
        f"SELECT metric, {sql_r4('s')} AS scenario, {sql_r4('b')} AS baseline, {sql_r4('(s - b)')} AS delta, "
        f"CASE WHEN (SELECT count(*) FROM obs WHERE {predicate}) > 0 THEN 'match' ELSE 'no match' END AS status "
        f"FROM ({' UNION ALL '.join(parts)})"
    )


@query("A11_scenario_comparison", _comparison_sql(_SCENARIO_SQL))
def scenario_comparison(spark, sf_dir):
    return rounded(A.scenario_comparison(observations(spark, sf_dir), **_SCENARIO))


@query("A11_scenario_without_match", _comparison_sql("corridor = 'nowhere'"))
def scenario_without_match(spark, sf_dir):
    return rounded(A.scenario_comparison(observations(spark, sf_dir), corridor="nowhere"))


@query(
    "A12_two_group_comparison",
    over_observations(
        f"SELECT CAST(position AS INTEGER) AS position, k.g AS \"group\", {sql_r4('avg(congestion_level)')} AS average_congestion, "
        f"{sql_r4('avg(CASE WHEN congestion_class = ' + chr(39) + 'High' + chr(39) + ' THEN 100e0 ELSE 0e0 END)')} "
        "AS high_percentage FROM (VALUES (1, true, 'Festival'), (2, false, 'Non-Festival')) k(position, flag, g) "
        "LEFT JOIN obs ON festival_flag = flag GROUP BY ALL"
    ),
)
def two_group_comparison(spark, sf_dir):
    data = observations(spark, sf_dir, "festival_flag", "congestion_level", S.TARGET)
    return rounded(A.compare_groups(data, "festival_flag", {True: "Festival", False: "Non-Festival"}))


@query(
    "A13_mean_by_weather",
    over_observations(
        f"SELECT weather AS label, {sql_r4('avg(congestion_level)')} AS average_congestion_level FROM obs "
        "WHERE day_type = 'Weekend' GROUP BY weather"
    ),
)
def mean_by_weather(spark, sf_dir):
    data = observations(spark, sf_dir, "weather", "day_type", "congestion_level")
    return rounded(A.scenario_breakdown(data, day_type="Weekend"))


@query(
    "A13_mean_by_day_type",
    over_observations(
        f"SELECT day_type AS label, {sql_r4('avg(congestion_level)')} AS average_congestion_level FROM obs "
        "WHERE weather = 'Fog' GROUP BY day_type"
    ),
)
def mean_by_day_type(spark, sf_dir):
    data = observations(spark, sf_dir, "weather", "day_type", "congestion_level")
    return rounded(A.scenario_breakdown(data, weather="Fog"))


@query(
    "A13_mean_scenario_and_all",
    over_observations(
        f"SELECT 'Selected Scenario' AS label, {sql_r4('avg(congestion_level)')} AS average_congestion_level FROM obs "
        "WHERE weather = 'Fog' AND day_type = 'Weekend' UNION ALL "
        f"SELECT 'All Historical Data', {sql_r4('avg(congestion_level)')} FROM obs"
    ),
)
def mean_scenario_and_all(spark, sf_dir):
    data = observations(spark, sf_dir, "weather", "day_type", "congestion_level")
    return rounded(A.scenario_breakdown(data, weather="Fog", day_type="Weekend"))


@query(
    "A14_dense_counts",
    over_observations(
        "SELECT CAST(position AS INTEGER) AS position, k.v AS value, count(obs_id) AS count "
        "FROM (VALUES (1, 'Clear'), (2, 'Rain'), (3, 'Snow')) k(position, v) LEFT JOIN obs ON weather = k.v GROUP BY ALL"
    ),
)
def dense_counts(spark, sf_dir):
    return A.dense_counts(observations(spark, sf_dir, "weather"), "weather", ["Clear", "Rain", "Snow"])


_CONTEXT_SQL = (
    "count(*) FILTER (festival_flag) AS festival, count(*) FILTER (holiday_flag) AS holiday, "
    "count(*) FILTER (roadwork = 'Yes') AS roadwork, count(*) FILTER (weather IN ('Rain', 'Fog')) AS rain_or_fog"
)


@query("A15_context_counts", over_observations(f"SELECT {_CONTEXT_SQL} FROM obs"))
def context_counts(spark, sf_dir):
    return A.context_counts(observations(spark, sf_dir, "festival_flag", "holiday_flag", "roadwork", "weather"))


@query(
    "A16_corridor_advisory_rollup",
    over_observations(
        "SELECT corridor, sum(n) OVER (PARTITION BY corridor)::BIGINT AS corridor_records, "
        "min(a) OVER (PARTITION BY corridor) AS date_start, max(b) OVER (PARTITION BY corridor) AS date_end, "
        "congestion_class, n AS record_count, advisory_level, recommendation, personnel_action, diversion_action, "
        "roadwork_action, sum(festival) OVER (PARTITION BY corridor)::BIGINT AS festival, "
        "sum(holiday) OVER (PARTITION BY corridor)::BIGINT AS holiday, "
        "sum(roadwork) OVER (PARTITION BY corridor)::BIGINT AS roadwork, "
        "sum(rain_or_fog) OVER (PARTITION BY corridor)::BIGINT AS rain_or_fog, CAST(0 AS INTEGER) AS conflict_count FROM ("
        f"SELECT corridor, congestion_class, count(*) AS n, min(date) AS a, max(date) AS b, {_CONTEXT_SQL} "
        "FROM obs GROUP BY ALL) JOIN actions ON class = congestion_class",
        ACTIONS_SQL,
    ),
)
def corridor_advisory_rollup(spark, sf_dir):
    data = observations(spark, sf_dir, "obs_id", *S.INTEGRATED_COLUMNS)
    rollup = corridor_rollup(advise(data))
    return rollup.select(
        "corridor",
        F.col("record_count").alias("corridor_records"),
        "date_start",
        "date_end",
        "festival",
        "holiday",
        "roadwork",
        "rain_or_fog",
        F.size("conflicts").alias("conflict_count"),
        F.inline("congestion_actions"),
    ).drop("rank")


@query(
    "A17_selection_summary",
    over_predictions(
        "SELECT count(*) AS record_count, count(DISTINCT corridor) AS corridor_count, "
        f"{_SQL_OF['low']} AS low_count, {_SQL_OF['medium']} AS medium_count, {_SQL_OF['high']} AS high_count, "
        "(SELECT count(*) FROM pred WHERE predicted_congestion_class = 'High') AS predicted_high_count, "
        "(SELECT count(*) FROM pred WHERE predicted_congestion_class = 'High') AS high_advisory_count "
        "FROM obs WHERE day_type = 'Weekend' AND NOT holiday_flag"
    ),
)
def selection_summary(spark, sf_dir):
    data = observations(spark, sf_dir, "corridor", S.TARGET, "day_type", "holiday_flag")
    selected = shape.filtered(data, day_types=["Weekend"], holiday_flag="False")
    needed = [n for n in S.PREDICTED_ADVISORY_COLUMNS[:11] if not n.endswith("congestion_class")]
    advised = advise_predictions(rule_predictions(spark, sf_dir, *needed))
    return A.selection_summary(selected, advised)


# ------------------------------------------------------------------ advisories
@query(
    "V1_congestion_rules",
    over_observations(
        "SELECT obs_id, congestion_class, advisory_level, recommendation, personnel_action, diversion_action, "
        "roadwork_action FROM obs LEFT JOIN actions ON class = congestion_class",
        ACTIONS_SQL,
    ),
)
def congestion_rules(spark, sf_dir):
    return apply_rules(observations(spark, sf_dir, "obs_id", S.TARGET))


@query(
    "V2_context_notes",
    over_observations(f"SELECT obs_id, {NOTES_SQL} AS context_notes FROM obs"),
)
def context_notes(spark, sf_dir):
    data = observations(spark, sf_dir, "obs_id", "festival_flag", "holiday_flag", "roadwork", "weather")
    return add_context_notes(data).select("obs_id", "context_notes")


@query(
    "V3_historical_advisories",
    over_observations(
        "SELECT obs_id, date, corridor, area, road_intersection, congestion_class, festival_flag, festival_name, "
        "holiday_flag, weather, roadwork, advisory_level, recommendation, personnel_action, diversion_action, "
        f"roadwork_action, {NOTES_SQL} AS context_notes FROM obs LEFT JOIN actions ON class = congestion_class",
        ACTIONS_SQL,
    ),
)
def historical_advisories(spark, sf_dir):
    return advise(observations(spark, sf_dir), "obs_id")


_PREDICTED_SQL = over_predictions(
    "SELECT obs_id, date, corridor, area, road_intersection, actual_congestion_class, predicted_congestion_class, "
    "festival_flag, festival_name, holiday_flag, weather, roadwork, advisory_level, recommendation, personnel_action, "
    f"diversion_action, roadwork_action, {NOTES_SQL} AS context_notes "
    "FROM pred LEFT JOIN actions ON class = predicted_congestion_class",
    ACTIONS_SQL,
)


def _predictions(spark, sf_dir):
    carried = [n for n in S.PREDICTED_ADVISORY_COLUMNS[:11] if not n.endswith("congestion_class")]
    return rule_predictions(spark, sf_dir, "obs_id", *carried)


@query("V4_predicted_advisories", _PREDICTED_SQL)
def predicted_advisories(spark, sf_dir):
    return advise_predictions(_predictions(spark, sf_dir), "obs_id")


@query("J2_predictions_join_advisories", _PREDICTED_SQL)
def predictions_join_advisories(spark, sf_dir):
    return advise_predictions_by_key(_predictions(spark, sf_dir), "obs_id")


# --------------------------------------------------------- sorts, limits, unions
@query("W2_sorted_small_result", _summary_sql("day_type_congestion_summary"))
def sorted_small_result(spark, sf_dir):
    """A global sort of two rows, from the shared cells of all summaries."""
    results = summaries.summarise_all(observations(spark, sf_dir))
    return rounded(results["day_type_congestion_summary"])


@query("W3_top_five", _summary_sql("top5_average_congestion_corridors"))
def top_five(spark, sf_dir):
    """The five best rows, kept by a bounded top-k instead of a full sort."""
    results = summaries.summarise_all(observations(spark, sf_dir))
    return rounded(results["top5_average_congestion_corridors"])


@query(
    "W4_advisories_in_order",
    over_predictions(
        "SELECT obs_id, date, corridor, predicted_congestion_class, advisory_level FROM pred "
        "LEFT JOIN actions ON class = predicted_congestion_class ORDER BY date, corridor, obs_id",
        ACTIONS_SQL,
    ),
)
def advisories_in_order(spark, sf_dir):
    advised = advise_predictions(_predictions(spark, sf_dir), "obs_id")
    return advised.select("obs_id", "date", "corridor", "predicted_congestion_class", "advisory_level").orderBy(
        "date", "corridor", "obs_id"
    )


@query(
    "W5_ascending_for_display",
    over_observations(
        f"SELECT corridor, {_SQL_OF['high%']} AS high_congestion_percentage FROM obs GROUP BY corridor "
        f"ORDER BY {_HI}, corridor"
    ),
)
def ascending_for_display(spark, sf_dir):
    data = observations(spark, sf_dir, "corridor", S.TARGET)
    shares = data.groupBy("corridor").agg(
        percentage(F.count_if(F.col(S.TARGET) == "High"), F.count(F.lit(1))).alias("high_congestion_percentage")
    )
    return rounded(shares.orderBy("high_congestion_percentage", "corridor"))


@query(
    "W6_distinct_rows",
    over_observations(
        f"SELECT date, area, road_intersection, corridor, {sql_r4('traffic_volume')} AS traffic_volume, "
        f"{sql_r4('average_speed')} AS average_speed, {sql_r4('travel_time_index')} AS travel_time_index, "
        f"{sql_r4('congestion_level')} AS congestion_level, congestion_class, weather, roadwork, day_of_week, day_type, "
        "festival_flag, festival_name, holiday_flag FROM d",
        "d AS (SELECT DISTINCT date, area, road_intersection, corridor, traffic_volume, average_speed, travel_time_index, "
        "congestion_level, congestion_class, weather, roadwork, day_of_week, day_type, festival_flag, festival_name, "
        "holiday_flag FROM obs)",
    ),
)
def distinct_rows(spark, sf_dir):
    return rounded(observations(spark, sf_dir, *S.INTEGRATED_COLUMNS).dropDuplicates())


@query("W7_union_of_models", _TWO_MODELS_SQL)
def union_of_models(spark, sf_dir):
    tables = {
        "volume rule": scoring.class_metrics(_matrix(spark, sf_dir)),
        "blended rule": scoring.class_metrics(scoring.confusion_matrix(_second_rule(spark, sf_dir))),
    }
    parts = [table.withColumn("model", F.lit(model)) for model, table in tables.items()]
    return rounded(parts[0].unionByName(parts[1]).drop("position"))
