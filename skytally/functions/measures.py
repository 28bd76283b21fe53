"""Aggregates over flights, for single flights and for rolled-up flights alike.

Every report measure is additive (counts, sums, maxima; a mean is a sum over a count). So a report reads either one row
per flight or one row per rollup group, and gets the same numbers. ``measures_of`` tells the two apart by a mark that a rollup puts on its counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions.columns import CAUSES, has_marked, marked

DELAYS = ("ARR_DELAY", "DEP_DELAY")


@dataclass(frozen=True)
class DelayStats:
    count: Column
    mean: Column
    max: Column


class FlightMeasures:
    """Measures over one row per flight."""

    rolled_up = False

    def flights(self) -> Column:
        return F.count("*")

    def is_cancelled(self) -> Column:
        return F.col("CANCELLED") == 1

    def cancelled(self, *, cancelled_only_input: bool = False) -> Column:
        return F.count("*") if cancelled_only_input else F.count(F.when(self.is_cancelled(), 1))

    def is_delayed(self, delay: str) -> Column:
        return F.col(delay) > 0

    def delay(self, delay: str, *, delayed_only_input: bool = False) -> DelayStats:
        """Statistics over delayed flights. With ``delayed_only_input`` the rows were already filtered by the caller,
        which lets the filter reach the scan and leaves plain aggregates here."""
        value = F.col(delay) if delayed_only_input else F.when(self.is_delayed(delay), F.col(delay))
        return DelayStats(F.count(value), F.avg(value), F.max(value))

    def minutes(self, cause: str) -> Column:
        return F.sum(cause)


class RollupMeasures(FlightMeasures):
    """The same measures over the groups built by ``plans.rollup``."""

    rolled_up = True

    def flights(self) -> Column:
        return F.sum("n_flights")

    def is_cancelled(self) -> Column:
        return F.col("n_cancelled") > 0

    def cancelled(self, *, cancelled_only_input: bool = False) -> Column:
        return F.sum("n_cancelled")

    def is_delayed(self, delay: str) -> Column:
        return F.col(f"{delay}_n") > 0

    def delay(self, delay: str, *, delayed_only_input: bool = False) -> DelayStats:
        count = F.sum(f"{delay}_n")
        return DelayStats(count, F.try_divide(F.sum(f"{delay}_sum"), count), F.max(f"{delay}_max"))


def measures_of(df: DataFrame) -> FlightMeasures:
    return RollupMeasures() if has_marked(df, "n_flights") else FlightMeasures()


def rollup_columns() -> list[Column]:
    """The additive columns a rollup keeps. Cause minutes keep their name: a sum of sums is the same expression."""
    columns = ["count(*) filter (where CANCELLED = 1) as n_cancelled"]
    for delay in DELAYS:
        delayed = f"filter (where {delay} > 0)"
        columns += [
            f"count(*) {delayed} as {delay}_n",
            f"sum({delay}) {delayed} as {delay}_sum",
            f"max({delay}) {delayed} as {delay}_max",
        ]
    return [marked(F.count("*"), "n_flights")] + [F.expr(c) for c in columns + [f"sum({c}) as {c}" for c in CAUSES]]


def merged_columns() -> dict[str, Column]:
    """How the columns of several rollups become those of one, by name."""
    out = {"n_flights": F.sum("n_flights"), "n_cancelled": F.sum("n_cancelled")}
    for delay in DELAYS:
        out |= {f"{delay}_n": F.sum(f"{delay}_n"), f"{delay}_sum": F.sum(f"{delay}_sum"), f"{delay}_max": F.max(f"{delay}_max")}
    return out | {cause: F.sum(cause) for cause in CAUSES}
