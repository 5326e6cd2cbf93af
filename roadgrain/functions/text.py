"""Name and query normalisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


WHITESPACE = " \t\n\r\x0b\x0c"


def strip(text: Column) -> Column:
    """Remove blanks, tabs and line ends on both sides."""
    return F.btrim(text, F.lit(WHITESPACE))


def normal_name(name: Column) -> Column:
    """Lower case, every run outside a-z and 0-9 becomes one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "))


def primary_place_name(display_name: Column) -> Column:
    """Part before the first comma, without bracketed parts, trimmed and lower case."""
    first = F.split(display_name, ",", 2).getItem(0)
    return F.lower(strip(F.regexp_replace(first, r"\s*\([^)]*\)", "")))


def is_meaningful_query(query: Column, at_least: int = 3) -> Column:
    """At least three letters or digits of any script."""
    return F.length(F.regexp_replace(query, r"[^\p{L}\p{N}]", "")) >= at_least


def localised_query(query: Column, city_spellings: list[str], suffix: str) -> Column:
    """Append the city suffix unless one of the city spellings already occurs."""
    lowered = F.lower(query)
    present = F.lit(False)
    for spelling in city_spellings:
        present = present | lowered.contains(spelling)
    return F.when(present, query).otherwise(F.concat(query, F.lit(suffix)))


def query_key(query: Column) -> Column:
    """Key under which equal place queries share one answer."""
    return F.lower(strip(query))
