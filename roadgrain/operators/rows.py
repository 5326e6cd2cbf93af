"""Small helpers that turn one wide row into named rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def unfold(one_row: DataFrame, rows: list[dict[str, Column]], *keep: str) -> DataFrame:
    """One output row per dict, with the dict's keys as columns, for every input row."""
    structs = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return one_row.select(*keep, F.inline(F.array(*structs)))


def as_checks(one_row: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """``checks(name, passed)``; a condition that is null has not passed."""
    return unfold(
        one_row,
        [{"name": F.lit(name), "passed": F.coalesce(passed, F.lit(False))} for name, passed in conditions.items()],
    )


def row_count(data: DataFrame) -> Column:
    """Number of rows as a scalar subquery."""
    return data.agg(F.count(F.lit(1))).scalar()


def look_up(rows: DataFrame, answers: DataFrame, key: str, spread: str, salts: int = 16) -> DataFrame:
    """Left join with a table that has one row per key; a very frequent key is spread over ``salts`` tasks.

    ``spread`` names a column of ``rows`` whose hash deals them out.
    """
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = answers.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [key, "_salt"], "left").drop("_salt")
