"""A calendar for every date of a span: flags, names and day categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadgrain.operators.calendar import day_category, neighbour_holidays


def date_spine(limits: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """Every date from ``first`` to ``last`` of a one-row table, both included."""
    return limits.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("date"))


def synthetic_calendar(days: DataFrame, festivals: DataFrame, holidays: DataFrame) -> DataFrame:
    """Flags, name (the text ``None`` without a festival) and category for every date.

    ``festivals`` is (date, festival_name), ``holidays`` is (date). A festival is a
    holiday too. Both must have unique dates.
    """
    all_holidays = holidays.select("date").union(festivals.select("date")).distinct()
    flagged = (
        days.select("date")
        .join(festivals.select("date", "festival_name"), "date", "left")
        .join(all_holidays.withColumn("is_holiday", F.lit(True)), "date", "left")
        .select(
            "date",
            F.coalesce("festival_name", F.lit("None")).alias("festival_name"),
            F.col("festival_name").isNotNull().alias("is_festival"),
            F.coalesce("is_holiday", F.lit(False)).alias("is_holiday"),
        )
    )
    return day_category(neighbour_holidays(flagged, all_holidays)).select(
        "date", "festival_name", "is_festival", "is_holiday", "day_type"
    )
