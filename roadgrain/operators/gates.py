"""Gates as tables: every function returns ``checks(name, passed)``.

Differences that involve null do not count as failures in the rule checks; nulls have
their own checks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from roadgrain import schemas as S
from roadgrain.operators.quality import duplicate_keys
from roadgrain.operators.rows import as_checks, row_count
from roadgrain.sources.files import listing


def require(checks: DataFrame) -> DataFrame:
    """The checks, failing at run time on the first that has not passed."""
    return checks.where(F.assert_true(F.col("passed"), F.concat(F.lit("Check failed: "), F.col("name"))).isNull())


def rows_kept(before: DataFrame | int, after: DataFrame) -> DataFrame:
    """``before`` may be the number of rows that was observed while the output was written."""
    wanted = F.lit(before) if isinstance(before, int) else row_count(before)
    return as_checks(after.agg(F.count(F.lit(1)).alias("n")), {"rows_kept": F.col("n") == wanted})


def write_observed(source: DataFrame, make: Callable[[DataFrame], DataFrame], path: str) -> dict[str, int]:
    """Write what ``make`` does of the source as Parquet; input_rows and output_rows, counted while rows pass by.

    No pass over the data is spent on the counts.
    """
    read, written = Observation("input"), Observation("output")
    counted = source.observe(read, F.count(F.lit(1)).alias("rows"))
    make(counted).observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return {"input_rows": read.get["rows"], "output_rows": written.get["rows"]}


def output_exists(spark: SparkSession, path: str) -> bool:
    """Whether files are stored at the path; only the listing is looked at."""
    try:
        return not listing(spark, path).isEmpty()
    except AnalysisException:
        return False


def expected_size(data: DataFrame, rows: int | Column, corridors: int | Column) -> DataFrame:
    totals = data.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("corridor").alias("c"))
    return as_checks(totals, {"expected_rows": F.col("n") == rows, "expected_corridors": F.col("c") == corridors})


def target_domain(data: DataFrame, target: str = S.TARGET) -> DataFrame:
    """The target holds exactly Low, Medium and High, and no null."""
    known = [F.max(F.when(F.col(target) == name, 1).otherwise(0)) for name in S.CLASSES]
    totals = data.agg(
        *[present.alias(name) for present, name in zip(known, S.CLASSES)],
        F.count_if(~F.coalesce(F.col(target).isin(S.CLASSES), F.lit(False))).alias("others"),
    )
    present = F.lit(True)
    for name in S.CLASSES:
        present = present & (F.col(name) == 1)
    return as_checks(totals, {"every_class_present": present, "no_other_value": F.col("others") == 0})


def split_quality(data: DataFrame, cutoff: Column, metrics: DataFrame, predictions: DataFrame | None = None) -> DataFrame:
    """Checks on a chronological split, its features and the metrics (metric, value) of a model.

    Both halves are looked at in the same pass over the data.
    """
    before, after = F.col("date") <= cutoff, F.col("date") > cutoff
    facts = data.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(before).alias("training"),
        F.count_if(after).alias("testing"),
        F.max(F.when(before, F.col("date"))).alias("last_training"),
        F.min(F.when(after, F.col("date"))).alias("first_testing"),
        F.count_if(F.col(S.TARGET).isNull()).alias("null_targets"),
        F.count_if(_any_null(S.FEATURES)).alias("null_features"),
    )
    bad_metrics = metrics.where(~F.coalesce(F.col("value").between(0.0, 1.0), F.lit(False)))
    conditions = {
        "halves_add_up": F.col("training") + F.col("testing") == F.col("n"),
        "no_null_target": F.col("null_targets") == 0,
        "no_null_feature": F.col("null_features") == 0,
        "training_before_testing": F.col("last_training") < F.col("first_testing"),
        "metrics_in_range": row_count(bad_metrics) == 0,
    }
    if predictions is not None:
        unlabelled = predictions.where(_any_null(["actual_congestion_class", "predicted_congestion_class"]))
        conditions["both_labels_present"] = row_count(unlabelled) == 0
    return as_checks(facts, conditions)


def _any_null(columns: list[str]) -> Column:
    found = F.lit(False)
    for name in columns:
        found = found | F.col(name).isNull()
    return found


def _note_errors(condition: Column, note: str) -> Column:
    """Rows whose context note disagrees with its condition."""
    start = S.CONTEXT_NOTES[note].split(";")[0]
    return F.count_if(condition != F.col("context_notes").contains(start))


def advisory_checks(
    source: DataFrame | int, advisories: DataFrame, key: list[str], output_exists: bool = True
) -> DataFrame:
    """Eleven checks on historical advisories; ``key`` is the pair or row id that must be unique.

    ``source`` may be the number of rows observed by ``write_observed``, which saves a pass over it.

    All rule checks come from one pass, merged per (class, level); the key needs a
    group-by of its own. Run it on the stored advisories rather than on the plan that
    makes them.
    """
    errors = {
        "festival": _note_errors(F.col("festival_flag") == F.lit(True), "festival"),
        "holiday": _note_errors(F.col("holiday_flag") == F.lit(True), "holiday"),
        "roadwork": _note_errors(F.col("roadwork") == "Yes", "roadwork"),
        "weather": _note_errors(F.col("weather").isin(S.ADVERSE_WEATHER), "weather"),
    }
    pairs = advisories.groupBy(S.TARGET, "advisory_level").agg(
        F.count(F.lit(1)).alias("rows"), *[count.alias(name) for name, count in errors.items()]
    )

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0))

    no_class = F.col(S.TARGET).isNull()
    totals = pairs.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n"),
        F.count(F.lit(1)).alias("pairs"),
        (F.count_distinct(S.TARGET) + F.coalesce(F.max(F.when(no_class, 1).otherwise(0)), F.lit(0))).alias("classes"),
        rows_where(no_class).alias("null_class"),
        rows_where(~F.col("advisory_level").isin(S.ADVISORY_LEVELS)).alias("bad_level"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in errors],
    )
    return as_checks(
        totals,
        {
            "input_row_count_equals_output_row_count": F.col("n")
            == (F.lit(source) if isinstance(source, int) else row_count(source)),
            "unique_key": row_count(duplicate_keys(advisories, key)) == 0,
            "no_null_congestion_class": F.col("null_class") == 0,
            "valid_advisory_levels": F.col("bad_level") == 0,
            "one_level_per_congestion_class": F.col("pairs") == F.col("classes"),
            "festival_context_rule": F.col("festival") == 0,
            "holiday_context_rule": F.col("holiday") == 0,
            "roadwork_context_rule": F.col("roadwork") == 0,
            "adverse_weather_context_rule": F.col("weather") == 0,
            "expected_output_columns": F.lit(set(S.ADVISORY_COLUMNS) == set(advisories.columns) - (set(key) - set(S.ADVISORY_COLUMNS))),
            "output_exists": F.lit(output_exists),
        },
    )


def predicted_advisory_checks(
    testing: DataFrame,
    predictions: DataFrame,
    advisories: DataFrame,
    key: list[str],
    period: tuple[Column, Column],
    metrics: DataFrame,
    expected_metrics: DataFrame,
    output_exists: bool = True,
    tolerance: float = 1e-6,
) -> DataFrame:
    """Eleven checks on predicted advisories.

    ``metrics`` and ``expected_metrics`` are (metric, value) tables; ``period`` is the
    first and last date the test rows must have.
    """
    labels = [F.col(name) for name in ("actual_congestion_class", "predicted_congestion_class")]
    unsupported = ~labels[0].isin(S.CLASSES) | ~labels[1].isin(S.CLASSES)
    scored = predictions.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if(unsupported).alias("unsupported"))
    ).scalar()
    span = testing.agg(F.struct(F.count(F.lit(1)).alias("n"), F.min("date").alias("a"), F.max("date").alias("b"))).scalar()
    differing = (
        metrics.select("metric", F.col("value").alias("v"))
        .join(expected_metrics.select("metric", F.col("value").alias("w")), "metric", "full")
        .where(~F.coalesce(F.abs(F.col("v") - F.col("w")) < tolerance, F.lit(False)))
    )
    totals = advisories.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(labels[1].isNull()).alias("null_predicted"),
        F.count_if(F.col("advisory_level").isNull()).alias("null_level"),
        F.count_if(~F.col("advisory_level").isin(S.ADVISORY_LEVELS)).alias("bad_level"),
    )
    columns = set(advisories.columns)
    return as_checks(
        totals,
        {
            "test_rows_equal_prediction_rows": (span.getField("n") == scored.getField("n"))
            & (F.col("n") == span.getField("n")),
            "actual_and_predicted_columns_present": F.lit(
                {"actual_congestion_class", "predicted_congestion_class"} <= set(predictions.columns)
            ),
            "actual_and_predicted_values_supported": scored.getField("unsupported") == 0,
            "advice_uses_predicted_class_only": F.lit(
                S.TARGET not in columns and "actual_congestion_class" in columns
            ),
            "unique_key": row_count(duplicate_keys(advisories, key)) == 0,
            "no_null_predicted_class": F.col("null_predicted") == 0,
            "no_null_advisory_level": F.col("null_level") == 0,
            "advisory_levels_supported": F.col("bad_level") == 0,
            "test_period_exact": (span.getField("a") == period[0]) & (span.getField("b") == period[1]),
            "metrics_match_baseline": row_count(differing) == 0,
            "output_exists": F.lit(output_exists),
        },
    )


# Columns each chart reads.
CHART_COLUMNS = {
    "integrated": {"congestion_class"},
    "corridor_congestion_summary": {"corridor", "average_congestion_level"},
    "day_type_congestion_summary": {"day_type", "average_congestion_level", "high_congestion_percentage"},
    "festival_congestion_summary": {"festival_flag", "average_congestion_level", "high_congestion_percentage"},
    "holiday_congestion_summary": {"holiday_flag", "average_congestion_level", "high_congestion_percentage"},
    "day_of_week_congestion_summary": {"day_of_week", "average_congestion_level", "high_congestion_percentage"},
    "top5_average_congestion_corridors": {"corridor", "average_congestion_level"},
    "top5_high_congestion_percentage_corridors": {"corridor", "high_congestion_percentage"},
    "prediction_advisory": {"actual_congestion_class", "predicted_congestion_class", "advisory_level"},
    "advisory": {"advisory_level"},
}


def chart_inputs(tables: dict[str, DataFrame]) -> DataFrame:
    """Per chart input: present, with its required columns, and not empty."""
    result = None
    for name, wanted in CHART_COLUMNS.items():
        table = tables.get(name)
        if table is None:
            continue
        complete = wanted <= set(table.columns)
        checks = as_checks(
            table.agg(F.count(F.lit(1)).alias("n")), {name: F.lit(complete) & (F.col("n") > 0)}
        )
        result = checks if result is None else result.unionByName(checks)
    return result
