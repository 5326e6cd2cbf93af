"""Rule-based advisories and their corridor roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadgrain import schemas as S
from roadgrain.functions.derive import adverse_weather, flag_is
from roadgrain.operators.aggregates import context_counters


def _action_map() -> Column:
    """The rules as one map literal: class -> struct of the five texts."""
    entries: list[Column] = []
    for name, texts in S.ADVISORY_RULES.items():
        entries += [F.lit(name), F.struct(*[F.lit(text).alias(column) for column, text in texts.items()])]
    return F.create_map(*entries)


def apply_rules(data: DataFrame, class_column: str = S.TARGET) -> DataFrame:
    """Add the five action columns; an unknown or null class gives nulls. Row-local."""
    actions = F.try_element_at(_action_map(), F.col(class_column))
    return data.withColumns({name: actions.getField(name) for name in S.ACTION_COLUMNS})


def add_context_notes(data: DataFrame) -> DataFrame:
    """Join the sentences that apply with ``; ``; empty text when none does."""
    conditions = {
        "festival": flag_is("festival_flag"),
        "holiday": flag_is("holiday_flag"),
        "roadwork": F.col("roadwork") == "Yes",
        "weather": adverse_weather(),
    }
    return data.withColumn(
        "context_notes", F.concat_ws("; ", *[F.when(conditions[name], text) for name, text in S.CONTEXT_NOTES.items()])
    )


def advise(data: DataFrame, *keep: str) -> DataFrame:
    """One advisory per observation. ``keep`` carries extra columns in front."""
    return add_context_notes(apply_rules(data)).select(*keep, *S.ADVISORY_COLUMNS)


def advise_predictions(predictions: DataFrame, *keep: str) -> DataFrame:
    """Advisories from the predicted class only.

    The rules run on the prediction row itself, so no join back on (date, corridor) is
    needed and rows that share that pair are not multiplied. The actual class is only
    carried along.
    """
    advised = add_context_notes(apply_rules(predictions, "predicted_congestion_class"))
    return advised.select(*keep, *S.PREDICTED_ADVISORY_COLUMNS)


def advise_predictions_by_key(predictions: DataFrame, key: str) -> DataFrame:
    """The same, as a left equi-join of predictions and advisories on a unique row key.

    For advisories that were stored apart from their predictions.
    """
    advised = advise_predictions(predictions, key).select(key, *S.ACTION_COLUMNS, "context_notes")
    carried = [name for name in S.PREDICTED_ADVISORY_COLUMNS if name not in advised.columns]
    return predictions.select(key, *carried).join(advised, key, "left").select(key, *S.PREDICTED_ADVISORY_COLUMNS)


def corridor_rollup(advisories: DataFrame) -> DataFrame:
    """Per corridor: rows, first and last date, context counts and one action set per class.

    ``congestion_actions`` is an array in the order Low, Medium, High. A class with two
    different action sets in one corridor is a conflict and named in ``conflicts``.
    The facts are merged per action set first, with the texts as keys: counts and dates
    alone keep that aggregate hash-based, where a minimum of texts would sort the facts.
    What follows works on a few rows per corridor.
    """
    known = [F.lit(name) for name in S.CLASSES]
    counters = context_counters()
    per_set = advisories.groupBy("corridor", S.TARGET, *S.ACTION_COLUMNS).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        *[c.alias(name) for name, c in counters.items()],
    )
    per_class = (
        per_set.groupBy("corridor", S.TARGET)
        .agg(
            F.sum("n").alias("n"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.count(F.lit(1)).alias("sets"),
            F.min(F.struct(*S.ACTION_COLUMNS)).alias("actions"),
            *[F.sum(name).alias(name) for name in counters],
        )
        .withColumn("rank", F.array_position(F.array(*known), F.col(S.TARGET)))
    )
    action = F.struct(
        F.col("rank"),
        F.col(S.TARGET).alias(S.TARGET),
        *[F.col(f"actions.{name}").alias(name) for name in S.ACTION_COLUMNS],
        F.col("n").alias("record_count"),
    )
    clash = F.when(F.col("sets") > 1, F.col(S.TARGET))
    return per_class.groupBy("corridor").agg(
        F.sum("n").alias("record_count"),
        F.min("first").alias("date_start"),
        F.max("last").alias("date_end"),
        F.array_sort(F.collect_list(F.when(F.col("rank") > 0, action))).alias("congestion_actions"),
        F.array_sort(F.collect_list(clash)).alias("conflicts"),
        *[F.sum(name).alias(name) for name in counters],
    )


def reject_conflicts(rollup: DataFrame) -> DataFrame:
    """The roll-up, failing at run time on the first corridor with conflicting actions."""
    message = F.concat(
        F.lit("Conflicting actions for "), F.array_join("conflicts", ", "), F.lit(" in corridor "), F.col("corridor")
    )
    return rollup.where(F.assert_true(F.size("conflicts") == 0, message).isNull())
