"""Data profiling and key checks; every function is one aggregate, not one job per column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadgrain import schemas as S
from roadgrain.operators.rows import unfold


def null_counts(data: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = columns or data.columns
    totals = data.agg(*[F.count_if(F.col(f"`{name}`").isNull()).alias(f"c{i}") for i, name in enumerate(names)])
    return unfold(
        totals, [{"column_name": F.lit(name), "null_count": F.col(f"c{i}")} for i, name in enumerate(names)]
    )


def duplicate_keys(data: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, with their row counts; null keys group together."""
    return data.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def duplicate_key_count(data: DataFrame, keys: list[str]) -> DataFrame:
    return duplicate_keys(data, keys).agg(F.count(F.lit(1)).alias("duplicate_key_count"))


def surplus_rows(data: DataFrame) -> DataFrame:
    """Rows, distinct rows and their difference.

    Copies are merged before the shuffle, so a row repeated very often costs no more
    than one partial result per task.
    """
    distinct = data.groupBy(*[F.col(f"`{name}`") for name in data.columns]).agg(F.count(F.lit(1)).alias("copies"))
    return distinct.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_row_count"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def distinct_values(data: DataFrame, column: str) -> DataFrame:
    return data.select(column).distinct().orderBy(column)


def distinct_counts(data: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per category column, exact unless asked otherwise.

    Exact counting of several columns multiplies every row by the number of columns, so
    the rows are first merged into the combinations that occur, which are few for
    categories. The result is right for any column.
    """
    if approximate:
        totals = data.agg(*[F.approx_count_distinct(F.col(name)).alias(f"c{i}") for i, name in enumerate(columns)])
    else:
        combinations = data.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
        totals = combinations.agg(*[F.count_distinct(F.col(name)).alias(f"c{i}") for i, name in enumerate(columns)])
    return unfold(
        totals, [{"column_name": F.lit(name), "distinct_count": F.col(f"c{i}")} for i, name in enumerate(columns)]
    )


def bounds(data: DataFrame, column: str = "date") -> DataFrame:
    return data.agg(F.min(column).alias("minimum"), F.max(column).alias("maximum"))


def numeric_summary(data: DataFrame, columns: list[str]) -> DataFrame:
    """Count, min, max, mean and sample standard deviation per column."""
    functions = {"count": F.count, "minimum": F.min, "maximum": F.max, "mean": F.mean, "stddev": F.stddev_samp}
    totals = data.agg(
        *[f(F.col(f"`{name}`")).alias(f"{label}{i}") for i, name in enumerate(columns) for label, f in functions.items()]
    )
    return unfold(
        totals,
        [
            {"column_name": F.lit(name), **{label: F.col(f"{label}{i}") for label in functions}}
            for i, name in enumerate(columns)
        ],
    )


def feature_inspection(data: DataFrame) -> DataFrame:
    """Every candidate feature: group, availability, use, nulls and distinct values.

    Rows (feature, feature_group, available, used, null_count, distinct_count). Features that are listed as
    unavailable without being candidates are the group ``unavailable``.
    """
    candidates = [(group, name) for group, names in S.FEATURE_CANDIDATES.items() for name in names]
    named = {name for _, name in candidates}
    candidates += [("unavailable", name) for name in S.UNAVAILABLE_FEATURES if name not in named]
    present = [name for _, name in candidates if name in data.columns]
    categories = [name for group, name in candidates if name in present and group in ("categorical", "temporal")]
    numeric = [name for name in present if name not in categories]
    # Merge the rows into category combinations first; see distinct_counts.
    combinations = data.groupBy(*categories).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"nulls_{name}") for name in numeric],
    )
    totals = combinations.agg(
        *[F.sum(f"nulls_{name}").alias(f"nulls_{name}") for name in numeric],
        *[F.sum(F.when(F.col(name).isNull(), F.col("rows")).otherwise(0)).alias(f"nulls_{name}") for name in categories],
        *[F.count_distinct(F.col(name)).alias(f"values_{name}") for name in categories],
    )
    missing = F.lit(None).cast("bigint")
    rows = []
    for group, name in candidates:
        rows.append(
            {
                "feature": F.lit(name),
                "feature_group": F.lit(group),
                "available": F.lit(name in present),
                "used": F.lit(name in present and name in S.FEATURES),
                "null_count": F.col(f"nulls_{name}") if name in present else missing,
                "distinct_count": F.col(f"values_{name}") if name in categories else missing,
            }
        )
    return unfold(totals, rows)


def feature_exclusions(data: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Columns kept out of the model with the reason and their non-null count.

    Asking for an excluded column as a feature is an error.
    """
    overlap = set(features or S.FEATURES) & set(S.EXCLUDED_FEATURES)
    if overlap:
        raise ValueError(f"Excluded columns used as features: {sorted(overlap)}")
    names = [name for name in S.EXCLUDED_FEATURES if name in data.columns]
    totals = data.agg(*[F.count(F.col(name)).alias(name) for name in names])
    return unfold(
        totals,
        [
            {
                "column_name": F.lit(name),
                "reason": F.lit(S.EXCLUDED_FEATURES[name]),
                "non_null_count": F.col(name),
            }
            for name in names
        ],
    )
