"""A compact table all reports can be read from, built in one scan.

Running many reports over raw flights scans them once per report. The rollup keeps additive measures per month, carrier,
route and cancellation code; its size follows the number of routes and months, not of flights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions.columns import has_marked, marked, month_of, year_of
from skytally.functions.measures import FlightMeasures, measures_of, merged_columns, rollup_columns

ROLLUP_KEYS = ("year", "month", "OP_CARRIER", "ORIGIN", "DEST", "CANCELLATION_CODE")


def rollup_flights(flights: DataFrame, keys: Sequence[str] = ROLLUP_KEYS) -> DataFrame:
    """One row per key combination with the measures every report needs. Fewer keys give a smaller table that serves
    fewer reports. A code on a flight that was not cancelled means nothing and must not split groups, so it is dropped.
    """
    if measures_of(flights).rolled_up:
        raise ValueError("the input is already rolled up")
    derived = {
        "year": marked(year_of(flights), "year"),
        "month": marked(month_of(flights), "month"),
        "CANCELLATION_CODE": F.when(FlightMeasures().is_cancelled(), F.col("CANCELLATION_CODE")),
    }
    grouped = flights.groupBy(*[derived[k] if k in ("year", "month") else derived.get(k, F.col(k)).alias(k) for k in keys])
    return grouped.agg(*rollup_columns())


def merge_rollups(*rollups: DataFrame) -> DataFrame:
    """One rollup of several, for example a stored one and that of a new year: equal to the rollup of all their flights.

    All have the same keys. Each flight has to be in one of them only. Groups that stand in several become one, with partial sums
    in every task, so the stored table is read once and none of the flights in it.
    """
    if not rollups:
        raise ValueError("no rollup given")
    measures = merged_columns()
    keys = [c for c in rollups[0].columns if c not in measures]
    for rollup in rollups:
        if not measures_of(rollup).rolled_up or set(rollup.columns) != {*keys, *measures}:
            raise ValueError("only rollups with the same keys can be merged")
    union = rollups[0]
    for rollup in rollups[1:]:
        union = union.unionByName(rollup)
    grouped = union.groupBy(*[marked(F.col(k), k) if has_marked(rollups[0], k) else F.col(k) for k in keys])
    return grouped.agg(*[column.alias(name) if name != "n_flights" else marked(column, name) for name, column in measures.items()])
