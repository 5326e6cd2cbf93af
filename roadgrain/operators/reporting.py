"""Run reports as long tables (section, name, value).

The rows are looked at once: they are merged to the combinations of the report's categories, with
counts, dates and sums that can be merged further, and stored. All distributions of a report then
come from that small table by one GROUPING SETS, told apart by their grouping ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from roadgrain import schemas as S
from roadgrain.operators import scoring
from roadgrain.operators.aggregates import context_counters
from roadgrain.operators.rows import unfold

PARTS = ("training", "testing")
ACTUAL, PREDICTED = "actual_congestion_class", "predicted_congestion_class"
#: How a measure of merged rows is merged again; the rest is summed.
_AGAIN = {"first": F.min, "last": F.max}


def merged(data: DataFrame, categories: list[str], store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One stored row for each combination of categories: rows, first and last date, context counts, null features."""
    measures = {"rows": F.count(F.lit(1))}
    if "date" in data.columns:
        measures |= {"first": F.min("date"), "last": F.max("date")}
    if {"festival_flag", "holiday_flag", "roadwork", "weather"} <= set(data.columns):
        measures |= context_counters()
    features = [name for name in S.FEATURES if name in data.columns]
    if len(features) == len(S.FEATURES):
        measures["null_features"] = F.count_if(F.greatest(*[F.col(c).isNull() for c in features]))
    return store(data.groupBy(*categories).agg(*[m.alias(name) for name, m in measures.items()]))


def distributions(combinations: DataFrame, sets: dict[str, tuple[str, ...]]) -> DataFrame:
    """The merged rows added up for several sets of categories; ``of`` names the set of a row.

    Categories outside a row's set are null in it.
    """
    names = list(dict.fromkeys(name for columns in sets.values() for name in columns))
    measures = [c for c, kind in combinations.dtypes if c in _AGAIN or kind == "bigint" and c not in names]
    of = F.lit(None).cast("string")
    for label, columns in sets.items():
        mask = sum(1 << (len(names) - 1 - i) for i, name in enumerate(names) if name not in columns)
        of = F.when(F.col("_set") == mask, label).otherwise(of)
    grouped = combinations.groupingSets([[F.col(c) for c in columns] for columns in sets.values()], *names).agg(
        F.grouping_id().alias("_set"), *[_AGAIN.get(m, F.sum)(m).alias(m) for m in measures]
    )
    return grouped.withColumn("of", of).drop("_set")


def _lines(rows: DataFrame, section: str, *named: tuple[Column | str, Column]) -> DataFrame:
    """One line for each row and entry; names and values are columns of the row."""
    entries = [
        {"section": F.lit(section), "name": F.lit(n) if isinstance(n, str) else n, "value": value.cast("string")}
        for n, value in named
    ]
    return unfold(rows, entries)


def _union(*parts: DataFrame) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _parts(found: DataFrame) -> DataFrame:
    """Rows and dates of both parts, and their sum."""
    part = found.where("of = 'part'")
    each = _lines(
        part,
        "dataset",
        (F.concat("part", F.lit(" rows")), F.col("rows")),
        (F.concat("part", F.lit(" first date")), F.col("first")),
        (F.concat("part", F.lit(" last date")), F.col("last")),
    )
    return _union(each, _lines(part.agg(F.sum("rows").alias("rows")), "dataset", ("total rows", F.col("rows"))))


def _shares(found: DataFrame, section: str, of: str, column: str) -> DataFrame:
    """count and percentage of each value of a column inside its part."""
    totals = found.where("of = 'part'").select("part", F.col("rows").alias("_all"))
    shares = found.where(F.col("of") == of).join(totals, "part")
    text = F.format_string("count=%d, percentage=%.4f%%", "rows", F.col("rows") * 100.0 / F.col("_all"))
    return _lines(shares, section, (F.concat_ws(" ", "part", F.coalesce(column, F.lit("null"))), text))


def _matrix(found: DataFrame, predicted: str = PREDICTED, of: str = "matrix") -> DataFrame:
    tested = found.where((F.col("of") == of) & (F.col("part") == "testing"))
    return tested.select(F.col(ACTUAL).alias("actual_class"), F.col(predicted).alias("predicted_class"), F.col("rows").alias("count"))


def _evaluation(matrix: DataFrame, section: str = "evaluation") -> DataFrame:
    return _lines(scoring.weighted_metrics(matrix), section, (F.col("metric"), F.format_string("%.6f", "value")))


def _cells(matrix: DataFrame, section: str = "confusion matrix") -> DataFrame:
    return _lines(matrix, section, (F.concat_ws(",", "actual_class", "predicted_class"), F.col("count")))


def _verdicts(checks: DataFrame) -> DataFrame:
    return _lines(checks, "validation", (F.col("name"), F.when(F.col("passed"), "PASS").otherwise("FAIL")))


def _context(found: DataFrame) -> DataFrame:
    return _lines(found, "context", *[(name, F.col(name)) for name in context_counters()])


def training_report(scored: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Of rows with ``part``, date, features, actual and predicted class: dataset, class shares, evaluation, quality.

    Only test rows are evaluated. Rows without a class are counted as ``null``.
    """
    combinations = merged(scored, ["part", ACTUAL, PREDICTED], store)
    found = distributions(
        combinations, {"part": ("part",), "class": ("part", ACTUAL), "matrix": ("part", ACTUAL, PREDICTED)}
    )
    matrix = _matrix(found)
    part = found.where("of = 'part'")
    span = part.agg(
        *[F.max(F.when(F.col("part") == name, F.col(edge))).alias(edge) for name, edge in zip(PARTS, ("last", "first"))]
    )
    quality = _lines(
        span, "quality", ("training before testing", F.when(F.col("last") < F.col("first"), "PASS").otherwise("FAIL"))
    )
    return _union(
        _parts(found),
        _shares(found, "class distribution", "class", ACTUAL),
        _evaluation(matrix),
        _cells(matrix),
        _lines(part, "quality", (F.concat("part", F.lit(" rows with a null feature")), F.col("null_features"))),
        quality,
    )


def benchmark_report(
    scored: DataFrame, models: dict[str, str], store: Callable[[DataFrame], DataFrame], importances: DataFrame | None = None
) -> DataFrame:
    """Several models (title: column of their class) on the same test rows; the last one's matrix and importances."""
    combinations = merged(scored, ["part", ACTUAL, *models.values()], store)
    sets = {"part": ("part",)} | {title: ("part", ACTUAL, column) for title, column in models.items()}
    found = distributions(combinations, sets)
    matrices = {title: _matrix(found, column, title) for title, column in models.items()}
    last = matrices[list(models)[-1]]
    parts = [_parts(found), *[_evaluation(m, title) for title, m in matrices.items()], _cells(last)]
    if importances is not None:
        value = F.format_string("%.6f", "importance")
        parts.append(_lines(importances, "grouped importances", (F.col("feature_group"), value)))
    return _union(*parts)


def advisory_report(
    advisories: DataFrame, store: Callable[[DataFrame], DataFrame], checks: DataFrame | None = None
) -> DataFrame:
    """Advisories by level and class, context counts and the outcome of their checks."""
    combinations = merged(advisories, ["advisory_level", S.TARGET], store)
    found = distributions(combinations, {"all": (), "level": ("advisory_level",), "class": (S.TARGET,)})
    whole = found.where("of = 'all'")
    parts = [
        _lines(whole, "dataset", ("total advisories", F.col("rows"))),
        _lines(found.where("of = 'level'"), "advisory level", (F.coalesce("advisory_level", F.lit("null")), F.col("rows"))),
        _lines(found.where("of = 'class'"), "congestion class", (F.coalesce(S.TARGET, F.lit("null")), F.col("rows"))),
        _context(whole),
    ]
    return _union(*parts, *([] if checks is None else [_verdicts(checks)]))


def prediction_report(
    advised: DataFrame, store: Callable[[DataFrame], DataFrame], checks: DataFrame | None = None
) -> DataFrame:
    """Of rows with ``part``, date, both classes and the level advised for the predicted one.

    Predictions, evaluation, advisories and context are those of the test rows.
    """
    combinations = merged(advised, ["part", ACTUAL, PREDICTED, "advisory_level"], store)
    found = distributions(
        combinations,
        {
            "part": ("part",),
            "prediction": ("part", PREDICTED),
            "matrix": ("part", ACTUAL, PREDICTED),
            "level": ("part", "advisory_level"),
        },
    )
    matrix = _matrix(found)
    tested = found.where("part = 'testing'")
    parts = [
        _parts(found),
        _lines(tested.where("of = 'prediction'"), "predictions", (F.coalesce(PREDICTED, F.lit("null")), F.col("rows"))),
        _evaluation(matrix),
        _cells(matrix),
        _lines(tested.where("of = 'level'"), "advisory level", (F.coalesce("advisory_level", F.lit("null")), F.col("rows"))),
        _context(tested.where("of = 'part'")),
    ]
    return _union(*parts, *([] if checks is None else [_verdicts(checks)]))


def feature_report(data: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows, dates, target shares, cardinalities and nulls of the categories, summaries of the numbers.

    Cardinalities count values, not nulls.
    """
    categories = [*S.CATEGORICAL_FEATURES, "day_of_week", *S.BOOLEAN_FEATURES, S.TARGET]
    sums = []
    for name in S.NUMERIC_MEASURES:
        column = F.col(name)
        sums += [F.count(column).alias(f"n_{name}"), F.min(column).alias(f"min_{name}"), F.max(column).alias(f"max_{name}")]
        sums += [F.sum(column).alias(f"sum_{name}")]
    combinations = store(
        data.groupBy(*categories).agg(
            F.count(F.lit(1)).alias("rows"), F.min("date").alias("first"), F.max("date").alias("last"), *sums
        )
    )
    rows, n = F.col("rows"), F.sum("rows")
    whole = combinations.agg(
        n.alias("rows"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        *[F.count_distinct(F.col(c)).alias(f"values_{c}") for c in categories],
        *[F.coalesce(F.sum(F.when(F.col(c).isNull(), rows)), F.lit(0)).alias(f"nulls_{c}") for c in categories],
        *[F.sum(F.when(F.col(S.TARGET) == name, rows)).alias(f"class_{name}") for name in S.CLASSES],
        *[f(f"{kind}_{c}").alias(f"{kind}_{c}") for c in S.NUMERIC_MEASURES for kind, f in (("n", F.sum), ("min", F.min), ("max", F.max), ("sum", F.sum))],
    )

    def number(column: Column) -> Column:
        return F.format_string("%.3f", column + F.lit(1e-7))

    shares = {
        name: F.format_string("count=%d, percentage=%.4f%%", f"class_{name}", F.col(f"class_{name}") * 100.0 / rows)
        for name in S.CLASSES
    }
    features = [*S.CATEGORICAL_FEATURES, "day_of_week", *S.BOOLEAN_FEATURES]
    numeric = {}
    for c in S.NUMERIC_MEASURES:
        numeric |= {f"{c} count": F.col(f"n_{c}"), f"{c} min": number(F.col(f"min_{c}")), f"{c} max": number(F.col(f"max_{c}"))}
        numeric[f"{c} mean"] = number(F.try_divide(F.col(f"sum_{c}"), F.col(f"n_{c}")))
    nulls = {c: F.col(f"nulls_{c}") for c in features} | {c: rows - F.col(f"n_{c}") for c in S.NUMERIC_MEASURES}
    sections = {
        "dataset": {"rows": rows, "first date": F.col("first"), "last date": F.col("last")},
        "target": shares,
        "distinct values": {c: F.col(f"values_{c}") for c in features},
        "null counts": nulls,
        "numeric summary": numeric,
    }
    entries = [
        {"section": F.lit(section), "name": F.lit(name), "value": value.cast("string")}
        for section, lines in sections.items()
        for name, value in lines.items()
    ]
    fixed = [("excluded", c, why) for c, why in S.EXCLUDED_FEATURES.items()]
    fixed += [("unavailable", c, "") for c in S.UNAVAILABLE_FEATURES]
    entries += [{k: F.lit(v) for k, v in zip(("section", "name", "value"), line)} for line in fixed]
    return unfold(whole, entries)
