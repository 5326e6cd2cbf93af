"""Chronological train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _calendar_dates(data: DataFrame, share: float) -> DataFrame:
    """One row: the sorted distinct dates and how many of them train."""
    distinct = data.where(F.col("date").isNotNull()).select("date").distinct()
    dates = distinct.agg(F.array_sort(F.collect_list("date")).alias("dates"))
    n = F.size("dates")
    training = F.greatest(F.lit(1), F.least(n - 1, F.floor(n * F.lit(share)).cast("int")))
    enough = F.assert_true(n >= 2, F.lit("At least two distinct dates are required for a chronological split."))
    return dates.where(enough.isNull()).select("dates", training.alias("training_dates"))


def cutoff_date(data: DataFrame, share: float = 0.80) -> DataFrame:
    """One row: the last training date, the number of dates, and of training dates.

    The first floor(share * n) of the n distinct dates train, at least one and at most
    n - 1. Dates are made distinct by hash, on both sides of a shuffle, before the
    one list of the calendar's dates is built. Fewer than two dates fail.
    """
    return _calendar_dates(data, share).select(
        F.element_at("dates", F.col("training_dates")).alias("cutoff_date"), F.size("dates").alias("date_count"), "training_dates"
    )


def test_period(data: DataFrame, share: float = 0.80) -> DataFrame:
    """One row: first and last date of the part that is held back for tests."""
    found = _calendar_dates(data, share)
    return found.select(
        F.element_at("dates", F.col("training_dates") + 1).alias("first_date"), F.element_at("dates", -1).alias("last_date")
    )


def with_part(data: DataFrame, cutoff) -> DataFrame:
    """Add ``part``: training up to the cutoff date, testing after it; a null date is in no part."""
    bound = cutoff if not isinstance(cutoff, str) else F.lit(cutoff).cast("date")
    return data.withColumn("part", F.when(F.col("date") <= bound, "training").when(F.col("date") > bound, "testing"))


def split_at(data: DataFrame, cutoff) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cutoff, and rows after it. ``cutoff`` is a date or a column."""
    bound = cutoff if not isinstance(cutoff, str) else F.lit(cutoff).cast("date")
    return data.where(F.col("date") <= bound), data.where(F.col("date") > bound)


def chronological_split(data: DataFrame, share: float = 0.80) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training rows, test rows and the one-row cutoff table, all lazy.

    The cutoff enters both filters as a scalar subquery; no date list reaches the driver.
    """
    cutoff = cutoff_date(data, share)
    training, testing = split_at(data, cutoff.select("cutoff_date").scalar())
    return training, testing, cutoff
