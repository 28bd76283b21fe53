"""Column expressions shared by the reports. All are built-in Spark expressions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The cancellation codes of the data set and what they stand for.
REASONS = {
    "A": "Carrier",
    "B": "Weather",
    "C": "National Air System",
    "D": "Security",
}

# The five columns that attribute delay minutes, and the names used in results.
CAUSES = {
    "CARRIER_DELAY": "Carrier",
    "WEATHER_DELAY": "Weather",
    "NAS_DELAY": "NAS",
    "SECURITY_DELAY": "Security",
    "LATE_AIRCRAFT_DELAY": "Late Aircraft",
}

UNKNOWN = "Unknown"


# Columns that the library itself derived carry this mark in their metadata; a column of the user's that happens to be
# called ``year`` does not. Marks survive Parquet.
_MARK = "skytally"


def marked(column: Column, name: str) -> Column:
    return column.alias(name, metadata={_MARK: name})


def has_marked(df: DataFrame, name: str) -> bool:
    return any(f.name == name and f.metadata.get(_MARK) == name for f in df.schema.fields)


def year_of(df: DataFrame) -> Column:
    """The year of the flight. Landed tables carry it as a partition column, so a year filter prunes directories."""
    return F.col("year") if has_marked(df, "year") else F.year("FL_DATE")


def month_of(df: DataFrame) -> Column:
    return F.col("month") if has_marked(df, "month") else F.month("FL_DATE")


def month_label(month: Column) -> Column:
    """Short English name of a month number, for axis labels."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMM")


def decode_reason(code: Column) -> Column:
    """Name of a cancellation code; a missing or unlisted code is ``Unknown``."""
    lookup = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    # try_element_at, because a plain lookup of an unlisted key is an error under ANSI in some Spark versions.
    return F.coalesce(F.try_element_at(lookup, F.trim(code)), F.lit(UNKNOWN))


def is_blank(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit("")) == ""


def percent_of(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` in percent; null when the whole is zero or missing."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def percent_change(new: Column, old: Column, digits: int) -> Column:
    """Growth from ``old`` to ``new`` in percent; null when the base is zero or missing."""
    return F.round(F.try_divide(new - old, old) * 100, digits)


def worst_first(measure: str, keys: Sequence[str]) -> list[Column]:
    """Largest measure first. The keys settle ties, so limits and ranks do not depend on task order."""
    return [F.desc_nulls_last(measure), *[F.asc_nulls_last(k) for k in keys]]
