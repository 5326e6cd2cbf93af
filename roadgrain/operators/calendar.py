"""Calendar join and neighbour-day categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def unique_calendar(calendar: DataFrame) -> DataFrame:
    """The calendar, failing at run time if a date (or null) occurs twice.

    The check is part of the plan, so it costs no extra job, and it runs on the
    dimension side before any fact row is joined.
    """
    values = ["festival_name", "festival_flag", "holiday_flag"]
    counted = calendar.groupBy("date").agg(
        F.count(F.lit(1)).alias("copies"), *[F.any_value(name).alias(name) for name in values]
    )
    message = F.concat(
        F.lit("Calendar has duplicate date keys: "), F.coalesce(F.col("date").cast("string"), F.lit("null"))
    )
    # The check is inside the key, so that a null-date group is looked at before the join drops it.
    checked = F.when(F.assert_true(F.col("copies") == 1, message).isNull(), F.col("date"))
    return counted.select(checked.alias("date"), *values)


def integrate_calendar(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Left join on ``date``; every fact row is kept once, missing flags become false.

    A calendar has at most one row per date, so the joined side stays small however
    many facts there are. Spark broadcasts it when its estimated size is under the
    threshold and falls back to a sort-merge join otherwise.
    """
    return facts.join(unique_calendar(calendar), "date", "left").select(
        *facts.columns,
        F.coalesce("festival_flag", F.lit(False)).alias("festival_flag"),
        "festival_name",
        F.coalesce("holiday_flag", F.lit(False)).alias("holiday_flag"),
    )


def neighbour_holidays(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Add ``next_is_holiday`` and ``previous_is_holiday`` to a table of dates.

    ``holidays`` is a table of holiday dates. Each holiday is turned into the two
    neighbouring dates it marks, so one equi-join answers both questions.
    """
    marks = (
        holidays.select(
            F.explode(
                F.array(
                    F.struct(F.date_sub("date", 1).alias("date"), F.lit(True).alias("before")),
                    F.struct(F.date_add("date", 1).alias("date"), F.lit(False).alias("before")),
                )
            ).alias("m")
        )
        .groupBy(F.col("m.date").alias("date"))
        .agg(
            F.bool_or(F.col("m.before")).alias("next_is_holiday"),
            F.bool_or(~F.col("m.before")).alias("previous_is_holiday"),
        )
    )
    return days.join(marks, "date", "left").select(
        *days.columns,
        F.coalesce("next_is_holiday", F.lit(False)).alias("next_is_holiday"),
        F.coalesce("previous_is_holiday", F.lit(False)).alias("previous_is_holiday"),
    )


def day_category(days: DataFrame) -> DataFrame:
    """Festival, day before or after a holiday, Friday, or a normal day; first match wins.

    Needs ``is_festival``, ``next_is_holiday`` and ``previous_is_holiday``.
    """
    friday = 6
    return days.withColumn(
        "day_type",
        F.when(F.col("is_festival"), "Festival Day")
        .when(F.col("next_is_holiday"), "Pre-Holiday")
        .when(F.col("previous_is_holiday"), "Post-Holiday")
        .when(F.dayofweek("date") == friday, "Friday Evening")
        .otherwise("Normal Day"),
    )
