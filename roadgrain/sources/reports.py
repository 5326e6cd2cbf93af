"""Metrics and matrices recovered from text reports and JSON specifications.

Every reader takes one document per row, so a folder of reports is one scan
(``spark.read.text(path, wholetext=True)``) and one projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadgrain import schemas as S
from roadgrain.functions.derive import decimal_number
from roadgrain.operators.rows import unfold
from roadgrain.operators.scoring import dense_matrix

# How each metric is written in a report.
METRIC_PATTERNS = {
    "Accuracy": r"Accuracy:\s*([0-9.]+)",
    "Weighted Precision": r"Weighted Precision:\s*([0-9.]+)",
    "Weighted Recall": r"Weighted Recall:\s*([0-9.]+)",
    "F1": r"(?:F1 Score|F1):\s*([0-9.]+)",
}
MATRIX_HEADER = "actual_class,predicted_class,count"
IMPORTANCE_TOLERANCE = 0.01


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Rows (report, text), one per file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("report"), F.col("value").alias("text")
    )


def _judged(data: DataFrame, absent, text, value) -> DataFrame:
    """Add value and problem for a cell that must exist, be a number and lie in [0, 1]."""
    return data.withColumn("value", value).withColumn(
        "problem",
        F.when(absent, "missing")
        .when(F.col("value").isNull() | F.isnan("value"), F.concat(F.lit("not numeric: "), text))
        .when(~F.col("value").between(0.0, 1.0), "outside [0, 1]"),
    )


def parse_metrics(reports: DataFrame, key: str = "report", text: str = "text") -> DataFrame:
    """Rows (key, metric, value, problem), four per report."""
    rows = [
        {"metric": F.lit(name), "found": F.regexp_extract(F.coalesce(F.col(text), F.lit("")), pattern, 1)}
        for name, pattern in METRIC_PATTERNS.items()
    ]
    found = unfold(reports, rows, key)
    return _judged(found, F.col("found") == "", F.col("found"), decimal_number(F.col("found"))).drop("found")


def parse_matrices(reports: DataFrame, key: str = "report", text: str = "text") -> DataFrame:
    """The first confusion block of each report as a dense matrix, three rows per report.

    A block ends at the first blank line. A report without a block, or with an empty one, gives
    one row with nothing but the key and the ``problem``: missing or empty.
    """
    rest = F.try_element_at(F.split(F.col(text), MATRIX_HEADER, 2), F.lit(2))
    block = F.try_element_at(F.split(F.regexp_replace(rest, r"^[^\n]*\n", ""), r"(?m)^[ \t\r]*$", 2), F.lit(1))
    lines = F.regexp_extract_all(block, F.lit(r"(?m)^\s*([A-Za-z]+,[A-Za-z]+,\d+)\s*$"), 1)
    found = reports.select(
        key,
        F.coalesce(lines, F.array().cast("array<string>")).alias("lines"),
        F.when(~F.coalesce(F.col(text).contains(MATRIX_HEADER), F.lit(False)), "missing")
        .when(F.size(lines) == 0, "empty")
        .alias("problem"),
    )
    cells = (
        found.select(key, F.explode("lines").alias("line"))
        .select(key, F.split("line", ",").alias("cell"))
        .select(
            key,
            F.col("cell")[0].alias("actual_class"),
            F.col("cell")[1].alias("predicted_class"),
            F.col("cell")[2].try_cast("bigint").alias("count"),
        )
    )
    matrix = dense_matrix(cells, S.CLASSES_ALPHABETIC, key).withColumn("problem", F.lit(None).cast("string"))
    return matrix.unionByName(found.where("problem IS NOT NULL").select(key, "problem"), allowMissingColumns=True)


def _json_field(text: str, *path: str):
    """A value inside a JSON document as text, null when absent; names may hold blanks."""
    return F.get_json_object(F.col(text), "$" + "".join(f"['{part}']" for part in path))


def parse_spec_metrics(specs: DataFrame, key: str = "spec", text: str = "text") -> DataFrame:
    """Rows (key, metric, value, problem) from the ``evaluation`` part of JSON specifications."""
    rows = [{"metric": F.lit(name), "found": _json_field(text, "evaluation", name)} for name in S.METRIC_NAMES]
    found = unfold(specs, rows, key)
    return _judged(found, F.col("found").isNull(), F.col("found"), decimal_number(F.col("found"))).drop("found")


def parse_importances(specs: DataFrame, key: str = "spec", text: str = "text") -> DataFrame:
    """Rows (key, feature_group, importance, problem), twelve per specification.

    Each group must be present, numeric and not negative. ``total_problem`` is set on
    all rows of a specification whose groups do not add up to about one.
    """
    values = F.array(
        *[
            F.struct(F.lit(name).alias("feature_group"), _json_field(text, "grouped_feature_importances", name).alias("t"))
            for name in S.FEATURES
        ]
    )
    cells = specs.select(key, values.alias("cells"))
    total = F.aggregate(
        "cells", F.lit(0.0), lambda acc, c: acc + F.coalesce(decimal_number(c.getField("t")), F.lit(0.0))
    )
    listed = cells.withColumn("total", total).select(key, "total", F.inline("cells"))
    importance = decimal_number(F.col("t"))
    return listed.select(
        key,
        "feature_group",
        importance.alias("importance"),
        F.when(F.col("t").isNull(), "missing")
        .when(importance.isNull(), "not numeric")
        .when(importance < 0, "negative")
        .alias("problem"),
        F.when(F.abs(F.col("total") - 1.0) > IMPORTANCE_TOLERANCE, "total is not 1").alias("total_problem"),
    )
