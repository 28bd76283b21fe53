"""The punctuality reports.

Every report takes flights, one row per flight or rolled up (``plans.rollup``), and returns a lazy DataFrame. Keys,
thresholds and cuts are arguments. "Delayed" means a delay above zero: early and on-time flights are not part of a
mean delay, and neither are flights without a delay value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions.columns import (
    CAUSES,
    decode_reason,
    is_blank,
    month_label,
    month_of,
    percent_of,
    worst_first,
    year_of,
)
from skytally.functions.measures import RollupMeasures, measures_of
from skytally.operators.grouped import grouped_report, wide_to_long
from skytally.operators.windows import change_over_periods, share_of_total, top_k_per_group
from skytally.plans.rollup import rollup_flights


def flight_count(flights: DataFrame) -> DataFrame:
    """Number of flights, as one row."""
    return flights.agg(measures_of(flights).flights().alias("total_flights"))


def volume_by_group(
    flights: DataFrame, keys: Sequence[str] = ("OP_CARRIER",), *, limit: int | None = None
) -> DataFrame:
    """Flights per carrier, busiest first."""
    return grouped_report(
        flights,
        keys,
        {"total_flights": measures_of(flights).flights()},
        order=worst_first("total_flights", keys),
        limit=limit,
    )


def delay_by_group(
    flights: DataFrame,
    keys: Sequence[str] = ("OP_CARRIER",),
    *,
    delay: str = "ARR_DELAY",
    only_positive: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Number, mean and maximum of the delays per carrier, worst mean first. ``only_positive=False`` takes every flight
    that has a delay value, early ones included; a rollup does not keep those."""
    m = measures_of(flights)
    if m.rolled_up and not only_positive:
        raise ValueError("a rollup keeps positive delays only")
    stats = m.delay(delay, delayed_only_input=True)
    return grouped_report(
        flights,
        keys,
        {
            "delayed_flights": stats.count,
            "avg_delay_min": F.round(stats.mean, 2),
            "max_delay_min": F.round(stats.max, 2),
        },
        where=m.is_delayed(delay) if only_positive else F.col(delay).isNotNull(),
        order=worst_first("avg_delay_min", keys),
        limit=limit,
    )


def cause_totals(flights: DataFrame, causes: Sequence[str] = tuple(CAUSES)) -> DataFrame:
    """Minutes lost to each cause, one row with a column per cause."""
    m = measures_of(flights)
    return flights.agg(*[F.round(m.minutes(c), 0).alias(f"{c.lower()}_min") for c in causes])


def worst_groups(
    flights: DataFrame,
    keys: Sequence[str] = ("ORIGIN",),
    *,
    delay: str = "DEP_DELAY",
    min_support: int = 1000,
    limit: int | None = None,
) -> DataFrame:
    """Origins by mean departure delay, worst first. Only origins with more than ``min_support`` delayed departures
    (exactly that many is not enough), so that one event cannot put a quiet airport on top."""
    m = measures_of(flights)
    stats = m.delay(delay, delayed_only_input=True)
    return grouped_report(
        flights,
        keys,
        {"delayed_departures": stats.count, "avg_dep_delay_min": F.round(stats.mean, 2)},
        where=m.is_delayed(delay),
        having=F.col("delayed_departures") > min_support,
        order=worst_first("avg_dep_delay_min", keys),
        limit=limit,
    )


def _reason_groups(flights: DataFrame, drop_blank: bool) -> DataFrame:
    m = measures_of(flights)
    where = m.is_cancelled()
    code = F.col("CANCELLATION_CODE")
    if drop_blank:
        where, code = where & ~is_blank(code), F.trim(code)
    measures = {"cancelled_flights": m.cancelled(cancelled_only_input=True)}
    return grouped_report(flights, {"CANCELLATION_CODE": code}, measures, where=where)


def reason_counts(flights: DataFrame, *, drop_blank: bool = False, decode: bool = False) -> DataFrame:
    """Cancelled flights per reason code. Flights without a code form a group of their own unless ``drop_blank``."""
    out = _reason_groups(flights, drop_blank)
    if decode:
        out = out.withColumn("reason", decode_reason(F.col("CANCELLATION_CODE")))
    return out.orderBy(*worst_first("cancelled_flights", ["CANCELLATION_CODE"]))


def reason_share(flights: DataFrame, *, drop_blank: bool = False, digits: int = 1) -> DataFrame:
    """Cancellations per reason with the decoded name and the percentage of all cancellations."""
    shares = share_of_total(_reason_groups(flights, drop_blank), "cancelled_flights", digits=digits)
    return shares.withColumn("reason", decode_reason(F.col("CANCELLATION_CODE"))).orderBy(
        *worst_first("cancelled_flights", ["CANCELLATION_CODE"])
    )


def monthly_trend(flights: DataFrame, *, delay: str = "ARR_DELAY", label: bool = False) -> DataFrame:
    """Mean delay per calendar month; the same month of all years counts together. ``label`` adds its short name."""
    m = measures_of(flights)
    stats = m.delay(delay, delayed_only_input=True)
    out = grouped_report(
        flights,
        {"month": month_of(flights)},
        {"avg_delay_min": F.round(stats.mean, 2)},
        where=m.is_delayed(delay),
        order=[F.asc("month")],
    )
    return out.withColumn("month_name", month_label(F.col("month"))) if label else out


def top_routes(
    flights: DataFrame,
    group: Sequence[str] = ("OP_CARRIER",),
    route: Sequence[str] = ("ORIGIN", "DEST"),
    *,
    delay: str = "ARR_DELAY",
    k: int = 3,
    min_support: int = 50,
) -> DataFrame:
    """The ``k`` routes with the worst mean delay of every carrier, among routes with more than ``min_support`` delayed
    flights. Ranks go by the rounded mean; equal means are ordered by route."""
    m = measures_of(flights)
    stats = m.delay(delay, delayed_only_input=True)
    routes = grouped_report(
        flights,
        [*group, *route],
        {"avg_delay_min": F.round(stats.mean, 2), "flight_count": stats.count},
        where=m.is_delayed(delay),
        having=F.col("flight_count") > min_support,
    )
    return top_k_per_group(routes, group, worst_first("avg_delay_min", route), k).orderBy(*group, "rank")


def top_carriers_per_year(
    flights: DataFrame,
    keys: Sequence[str] = ("OP_CARRIER",),
    *,
    delay: str = "ARR_DELAY",
    k: int = 5,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """The ``k`` carriers with the worst mean delay of every year, or of the given years only."""
    m = measures_of(flights)
    stats = m.delay(delay, delayed_only_input=True)
    year = year_of(flights)
    where = m.is_delayed(delay)
    if years is not None:
        where = where & year.isin(*years)
    carriers = grouped_report(
        flights,
        {"year": year, **{c: F.col(c) for c in keys}},
        {"avg_delay_min": F.round(stats.mean, 2), "delayed_flights": stats.count},
        where=where,
    )
    return top_k_per_group(carriers, ["year"], worst_first("avg_delay_min", keys), k).orderBy("year", "rank")


def _year_groups(flights: DataFrame, digits: int | None = 2) -> DataFrame:
    m = measures_of(flights)
    arrivals = m.delay("ARR_DELAY")
    rate = F.try_divide(m.cancelled(), m.flights()) * 100
    return grouped_report(
        flights,
        {"year": year_of(flights)},
        {
            "total_flights": m.flights(),
            "delayed_flights": arrivals.count,
            "cancellations": m.cancelled(),
            "avg_delay_min": arrivals.mean if digits is None else F.round(arrivals.mean, digits),
            "cancel_rate_pct": rate if digits is None else F.round(rate, digits),
        },
    )


def year_summary(flights: DataFrame) -> DataFrame:
    """Flights, delayed flights, cancellations, mean delay and cancellation rate per year, in one pass. A year without
    cancellations has the rate 0."""
    return _year_groups(flights).orderBy("year")


def year_summary_change(flights: DataFrame, *, digits: int = 1, adjacent_only: bool = False) -> DataFrame:
    """Percent change of every ``year_summary`` figure against the previous year in the data, from unrounded figures."""
    metrics = ["total_flights", "delayed_flights", "cancellations", "avg_delay_min", "cancel_rate_pct"]
    changes = {c: f"{c}_change_pct" for c in metrics}
    years = _year_groups(flights, digits=None)  # one row per calendar year
    out = change_over_periods(years, "year", changes, by=(), digits=digits, adjacent_only=adjacent_only)
    return out.select("year", *changes.values()).orderBy("year")


def _cause_minutes_per_year(
    flights: DataFrame, names: Mapping[str, str], unit: float, digits: int | None
) -> DataFrame:
    m = measures_of(flights)

    def scaled(cause: str) -> Column:
        minutes = m.minutes(cause) / unit
        return minutes if digits is None else F.round(minutes, digits)

    return grouped_report(flights, {"year": year_of(flights)}, {n: scaled(c) for c, n in names.items()})


def year_cause_minutes(
    flights: DataFrame, causes: Sequence[str] = tuple(CAUSES), *, unit: float = 1e6, digits: int = 2
) -> DataFrame:
    """Minutes lost per year and cause, in millions; one column per cause, all summed in one pass."""
    names = {c: c.lower().replace("_delay", "_min") for c in causes}
    return _cause_minutes_per_year(flights, names, unit, digits).orderBy("year")


def cause_change(
    flights: DataFrame,
    causes: Mapping[str, str] = CAUSES,
    *,
    unit: float = 1.0,
    unit_digits: int | None = None,
    digits: int = 1,
    adjacent_only: bool = False,
) -> DataFrame:
    """Percent change of the minutes lost to each cause against the previous year in the data; null from a zero base.
    ``unit=1e6, unit_digits=2`` takes the change between figures already rounded to hundredths of a million."""
    names = {c: c for c in causes}
    wide = _cause_minutes_per_year(flights, names, unit, unit_digits)
    long = wide_to_long(wide, ["year"], causes, "cause", "total_min")
    changes = {"total_min": "change_pct"}
    out = change_over_periods(long, "year", changes, by=["cause"], digits=digits, adjacent_only=adjacent_only)
    return out.orderBy("cause", "year")


def cause_share(flights: DataFrame, causes: Mapping[str, str] = CAUSES, *, digits: int = 1) -> DataFrame:
    """Minutes and percentage of all delay minutes per cause, largest first. Shares come from unrounded sums."""
    m = measures_of(flights)
    wide = flights.agg(*[m.minutes(c).alias(c) for c in causes])
    # The whole stands in the same single row as its parts, so it travels along instead of being summed again.
    whole = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in causes), F.lit(0.0))
    long = wide_to_long(wide.withColumn("whole", whole), ["whole"], causes, "cause", "total_min")
    shares = long.withColumn("share_pct", percent_of(F.col("total_min"), F.col("whole"), digits)).drop("whole")
    return shares.orderBy(*worst_first("total_min", ["cause"]))


_HEADLINE_KEYS = ("OP_CARRIER", "ORIGIN", "month", "CANCELLATION_CODE")


def headline_extremes(flights: DataFrame, *, min_support: int = 1000) -> DataFrame:
    """One row: busiest and worst carrier, worst origin, worst and best month, top cause, top cancellation reason.
    Flights without a carrier, origin or month do not compete for these; a missing reason does, as ``Unknown``.

    Flights are scanned once, into a small rollup. Its groups are then regrouped by each key alone, and the extremes
    picked with partial minima, so no task sees more than the group counts of a few tasks.
    """
    rolled = flights if measures_of(flights).rolled_up else rollup_flights(flights, _HEADLINE_KEYS)
    m = RollupMeasures()
    arrivals, departures = m.delay("ARR_DELAY"), m.delay("DEP_DELAY")
    groups = rolled.groupingSets([[k] for k in _HEADLINE_KEYS] + [[]], *_HEADLINE_KEYS).agg(
        *[F.grouping(k).alias(f"without_{k}") for k in _HEADLINE_KEYS],
        m.flights().alias("flights"),
        F.round(arrivals.mean, 2).alias("arr_mean"),
        departures.count.alias("dep_n"),
        F.round(departures.mean, 2).alias("dep_mean"),
        m.cancelled().alias("cancelled"),
        *[m.minutes(c).alias(c) for c in CAUSES],
    )

    def extreme(key: str, measure: str, *, lowest: bool = False, where: Column | None = None) -> Column:
        """The measure and the key of the best group; equal measures go to the first key."""
        value = F.col(measure)
        keep = (F.col(f"without_{key}") == 0) & value.isNotNull()
        if key != "CANCELLATION_CODE":
            keep = keep & F.col(key).isNotNull()
        if where is not None:
            keep = keep & where
        rank = F.struct(
            (value if lowest else -value).alias("order"),
            F.col(key).isNull().alias("last"),
            F.col(key).alias("key"),
            value.alias("value"),
        )
        return F.min(F.when(keep, rank))

    is_total = F.lit(True)
    for k in _HEADLINE_KEYS:
        is_total = is_total & (F.col(f"without_{k}") == 1)
    picked = groups.agg(
        extreme("OP_CARRIER", "flights").alias("volume"),
        extreme("OP_CARRIER", "arr_mean").alias("carrier"),
        extreme("ORIGIN", "dep_mean", where=F.col("dep_n") > min_support).alias("origin"),
        extreme("month", "arr_mean").alias("high"),
        extreme("month", "arr_mean", lowest=True).alias("low"),
        extreme("CANCELLATION_CODE", "cancelled", where=F.col("cancelled") > 0).alias("reason"),
        F.max(F.when(is_total, F.col("cancelled"))).alias("cancelled"),
        *[F.max(F.when(is_total, F.col(c))).alias(c) for c in CAUSES],
    )
    causes = F.array(
        *[
            F.when(
                F.col(c).isNotNull(),
                F.struct((-F.col(c)).alias("order"), F.lit(n).alias("key"), F.col(c).alias("value")),
            )
            for c, n in CAUSES.items()
        ]
    )
    whole = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in CAUSES), F.lit(0.0))
    top_cause = F.array_min(causes)
    return picked.select(
        F.col("volume.key").alias("busiest_carrier"),
        F.col("volume.value").alias("busiest_carrier_flights"),
        F.col("carrier.key").alias("worst_carrier"),
        F.col("carrier.value").alias("worst_carrier_avg_delay_min"),
        F.col("origin.key").alias("worst_origin"),
        F.col("origin.value").alias("worst_origin_avg_dep_delay_min"),
        F.col("high.key").alias("worst_month"),
        F.col("low.key").alias("best_month"),
        top_cause["key"].alias("top_cause"),
        percent_of(top_cause["value"], whole, 1).alias("top_cause_pct"),
        F.when(F.col("reason").isNotNull(), decode_reason(F.col("reason.key"))).alias("top_reason"),
        percent_of(F.col("reason.value"), F.col("cancelled"), 1).alias("top_reason_pct"),
    )
