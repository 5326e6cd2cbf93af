"""Confusion matrices and the metrics that follow from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadgrain import schemas as S
from roadgrain.operators.rows import unfold

ACTUAL, PREDICTED = "actual_congestion_class", "predicted_congestion_class"


def confusion_matrix(predictions: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Rows (actual_class, predicted_class, count) for the pairs that occur."""
    return (
        predictions.groupBy(F.col(actual).alias("actual_class"), F.col(predicted).alias("predicted_class"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("actual_class", "predicted_class")
    )


def dense_matrix(matrix: DataFrame, classes: list[str] = S.CLASSES, *keys: str) -> DataFrame:
    """One row per actual class and one column per predicted class, zero where absent."""
    cells = [
        F.coalesce(
            F.sum(F.when((F.col("actual_class") == a) & (F.col("predicted_class") == p), F.col("count"))), F.lit(0)
        )
        .cast("bigint")
        .alias(f"{a}_{p}")
        for a in classes
        for p in classes
    ]
    totals = matrix.groupBy(*keys).agg(*cells) if keys else matrix.agg(*cells)
    return unfold(
        totals,
        [
            {"position": F.lit(i + 1), "actual_class": F.lit(a), **{p: F.col(f"{a}_{p}") for p in classes}}
            for i, a in enumerate(classes)
        ],
        *keys,
    )


def _class_totals(matrix: DataFrame) -> DataFrame:
    aggregates = []
    for name in S.CLASSES_ALPHABETIC:
        actual, predicted = F.col("actual_class") == name, F.col("predicted_class") == name
        known = F.col("actual_class").isin(S.CLASSES) & F.col("predicted_class").isin(S.CLASSES)
        aggregates += [
            F.coalesce(F.sum(F.when(actual & predicted, F.col("count"))), F.lit(0)).alias(f"hit_{name}"),
            F.coalesce(F.sum(F.when(predicted & known, F.col("count"))), F.lit(0)).alias(f"said_{name}"),
            F.coalesce(F.sum(F.when(actual & known, F.col("count"))), F.lit(0)).alias(f"support_{name}"),
        ]
    return matrix.agg(*aggregates)


def _ratio(part, whole):
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _scores(name: str):
    hit, said, support = (F.col(f"{kind}_{name}").cast("double") for kind in ("hit", "said", "support"))
    precision, recall = _ratio(hit, said), _ratio(hit, support)
    return precision, recall, _ratio(2.0 * precision * recall, precision + recall), F.col(f"support_{name}")


def class_metrics(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class in the order High, Low, Medium."""
    rows = []
    for i, name in enumerate(S.CLASSES_ALPHABETIC):
        precision, recall, f1, support = _scores(name)
        rows.append(
            {
                "position": F.lit(i + 1),
                "class": F.lit(name),
                "precision": precision,
                "recall": recall,
                "f1": f1,
                "support": support,
            }
        )
    return unfold(_class_totals(matrix), rows)


def weighted_metrics(matrix: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 as rows (metric, value)."""
    total = hits = F.lit(0.0)
    weighted = [F.lit(0.0)] * 3
    for name in S.CLASSES_ALPHABETIC:
        *scores, support = _scores(name)
        weighted = [acc + support * score for acc, score in zip(weighted, scores)]
        total, hits = total + support, hits + F.col(f"hit_{name}")
    values = [_ratio(value, total) for value in (hits, *weighted)]
    return unfold(
        _class_totals(matrix),
        [{"metric": F.lit(name), "value": value} for name, value in zip(S.METRIC_NAMES, values)],
    )


def compare_models(metrics: dict[str, DataFrame]) -> DataFrame:
    """One row per metric and one value column per model."""
    result = None
    for model, table in metrics.items():
        named = table.select("metric", F.col("value").alias(model))
        result = named if result is None else result.join(named, "metric", "full")
    return result


def compare_classes(per_class: dict[str, DataFrame]) -> DataFrame:
    """Per-class metrics of several models, interleaved class by class."""
    result = None
    for i, (model, table) in enumerate(per_class.items()):
        named = table.withColumns({"model": F.lit(model), "model_position": F.lit(i + 1)})
        result = named if result is None else result.unionByName(named)
    return result.orderBy("position", "model_position").select(
        "class", "model", "precision", "recall", "f1", "support"
    )
