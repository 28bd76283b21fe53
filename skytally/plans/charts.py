"""The data behind the charts: report rows in chart units. Drawing is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.plans import reports


def volume_in_millions(flights: DataFrame, *, limit: int = 10) -> DataFrame:
    """Busiest carriers, with flights in millions as bar heights."""
    out = reports.volume_by_group(flights, limit=limit)
    return out.withColumn("total_flights_m", F.col("total_flights") / 1e6)


def year_overview(flights: DataFrame) -> DataFrame:
    """Per year: flights and delayed flights in millions, cancellations in thousands, mean delay."""
    return reports.year_summary(flights).select(
        "year",
        (F.col("total_flights") / 1e6).alias("total_flights_m"),
        (F.col("delayed_flights") / 1e6).alias("delayed_flights_m"),
        (F.col("cancellations") / 1e3).alias("cancellations_k"),
        "avg_delay_min",
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    """Lowest and highest value of a result column, for the ends of an axis."""
    return df.agg(F.min(column).alias("lowest"), F.max(column).alias("highest"))


def chart_frames(flights: DataFrame, years: tuple[int, ...] | None = None) -> dict[str, DataFrame]:
    """One frame per chart. A rollup as input keeps ten charts from scanning the flights ten times."""
    return {
        "flights_per_carrier": volume_in_millions(flights),
        "delay_per_carrier": reports.delay_by_group(flights, limit=10),
        "delay_causes": reports.cause_share(flights),
        "monthly_trend": reports.monthly_trend(flights, label=True),
        "cancellation_reasons": reports.reason_share(flights),
        "year_overview": year_overview(flights),
        "worst_origins": reports.worst_groups(flights, limit=10),
        "year_summary": reports.year_summary(flights),
        "cause_change": reports.cause_change(flights, unit=1e6, unit_digits=2),
        "top_carriers": reports.top_carriers_per_year(flights, years=years),
    }
