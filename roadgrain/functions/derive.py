"""Scalar rules on traffic rows: classes, calendar fields, durations, delays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roadgrain import schemas as S


def parse_date(column: Column | str) -> Column:
    """ISO date text to date; anything else becomes null."""
    return F.try_to_date(F.col(column) if isinstance(column, str) else column, "yyyy-MM-dd")


def threshold_class(
    level: Column, low_below: float = S.LOW_BELOW, medium_below: float = S.MEDIUM_BELOW
) -> Column:
    """Low / Medium / High by two cut points; null stays null and NaN counts as High."""
    if not low_below < medium_below:
        raise ValueError("Congestion cut points must increase strictly.")
    return F.when(
        level.isNotNull(),
        F.when(level < low_below, "Low").when(level < medium_below, "Medium").otherwise("High"),
    )


def day_type(day_of_week: Column) -> Column:
    """Weekend on days 1 (Sunday) and 7 (Saturday), null on null."""
    return F.when(
        day_of_week.isNotNull(),
        F.when(day_of_week.isin(S.WEEKEND_DAYS), "Weekend").otherwise("Weekday"),
    )


def corridor_name(area: Column, road: Column, separator: str = S.CORRIDOR_SEPARATOR) -> Column:
    return F.concat(area, F.lit(separator), road)


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole as a double, null when the whole is zero."""
    return F.try_divide(F.lit(100.0) * part, whole.cast("double"))


def is_high(class_column: str = S.TARGET) -> Column:
    return F.col(class_column) == "High"


def flag_is(column: str) -> Column:
    """True only for a true flag; null counts as not set."""
    return F.coalesce(F.col(column), F.lit(False))


def adverse_weather(column: str = "weather") -> Column:
    return F.col(column).isin(S.ADVERSE_WEATHER)


def whole_minutes(seconds: Column) -> Column:
    """Seconds to minutes, half to even; null if they are not finite."""
    return F.rint(seconds / 60.0).try_cast("bigint")


def duration_text(seconds: Column) -> Column:
    """``38 min``, ``1 hr``, ``1 hr 12 min``; at least one minute unless zero or less."""
    minutes = F.greatest(F.lit(1).cast("bigint"), whole_minutes(seconds))
    hours, rest = F.floor(minutes / 60), minutes % 60
    hour_part = F.concat(hours.cast("string"), F.lit(" hr"))
    return (
        F.when(seconds <= 0, "0 min")
        .when(minutes < 60, F.concat(minutes.cast("string"), F.lit(" min")))
        .when(rest == 0, hour_part)
        .otherwise(F.concat(hour_part, F.lit(" "), rest.cast("string"), F.lit(" min")))
    )


def kilometres(metres: Column) -> Column:
    return F.bround(metres / 1000.0, 1)


def minutes_2dp(seconds: Column) -> Column:
    return F.bround(seconds / 60.0, 2)


def load_ratio_class(volume: Column, capacity: Column) -> Column:
    """Severe from 0.9, High from 0.7, Moderate from 0.45 of capacity, else Low."""
    ratio = volume.cast("double") / capacity.cast("double")
    return (
        F.when(ratio >= 0.9, "Severe").when(ratio >= 0.7, "High").when(ratio >= 0.45, "Moderate").otherwise("Low")
    )


def is_finite(value: Column) -> Column:
    """False for null, NaN and both infinities."""
    return F.coalesce(
        ~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))),
        F.lit(False),
    )


def decimal_number(cell: Column) -> Column:
    """Text to double if it is written as a decimal number, ``nan`` or an infinity; else null.

    A cast alone also takes type suffixes and hexadecimal forms (``12.5d``, ``0x1p3``).
    """
    shape = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|nan|inf|infinity)\s*$"
    return F.when(cell.rlike(shape), cell.try_cast("double"))


def in_range(value: Column, low: float, high: float) -> Column:
    return F.coalesce(is_finite(value) & value.between(low, high), F.lit(False))


def round_half_up(value: Column) -> Column:
    return F.floor(value + 0.5)


def illustrative_delay(minutes: Column, kilometres_: Column, class_: Column) -> Column:
    """struct(standard_minutes, adjusted_minutes, delay_percent), null on bad input."""
    multiplier = F.lit(None).cast("double")
    for name, factor in S.DELAY_MULTIPLIER.items():
        multiplier = F.when(class_ == name, F.lit(factor)).otherwise(multiplier)
    valid = (
        is_finite(minutes) & (minutes >= 0) & is_finite(kilometres_) & (kilometres_ >= 0) & multiplier.isNotNull()
    )
    standard = round_half_up(minutes)
    adjusted = round_half_up(minutes * multiplier)
    delay = F.when(standard > 0, round_half_up((adjusted - standard) / standard * 100.0)).otherwise(
        F.lit(0).cast("bigint")
    )
    return F.when(
        F.coalesce(valid, F.lit(False)),
        F.struct(
            standard.alias("standard_minutes"),
            adjusted.alias("adjusted_minutes"),
            delay.alias("delay_percent"),
        ),
    )


def json_number(value: Column, absent: float = 0.0) -> Column:
    """A variant as a double: an absent field is ``absent``, written numbers count as the text reader takes them.

    JSON null, lists, objects and other text are null; true and false are 1 and 0.
    """
    return (
        F.when(value.isNull(), F.lit(absent))
        .when(F.schema_of_variant(value) == "STRING", decimal_number(F.try_variant_get(value, "$", "string")))
        .otherwise(F.try_variant_get(value, "$", "double"))
    )


def provider_error(message: Column, provider: Column) -> Column:
    """struct(status, error_code) for a geocoding or routing error text."""
    text = F.lower(message)

    def says(marks: list[str]) -> Column:
        return F.coalesce(text.rlike("|".join(marks)), F.lit(False))

    code = F.lit(None).cast("string")
    for name, (timeout, missing, other) in S.PROVIDER_CODES.items():
        of_this = F.when(says(S.TIMEOUT_MARKS), timeout).when(says(S.MISSING_MARKS[name]), missing).otherwise(other)
        code = F.when(provider == name, of_this).otherwise(code)
    return F.struct(request_status(code).alias("status"), code.alias("error_code"))


def request_status(code: Column) -> Column:
    """Status that belongs to an error code; 200 without one."""
    status = F.lit(200)
    for name, number in S.REQUEST_STATUS.items():
        status = F.when(code == name, number).otherwise(status)
    return status
