"""Ranks, shares and period-over-period changes on aggregated rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.functions.columns import percent_change, percent_of


_TASK = "__input_task"


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, *, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of every group, ranked 1, 2, 3 without gaps.

    The filter sits directly on the rank, so Spark cuts every group to ``k`` rows in each task before the shuffle: a
    group that holds a third of the rows sends ``k`` rows per task, not its whole content. Spark does so up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by default). For a larger ``k``, groups are first cut to ``k`` rows of
    every input task, in a shuffle by group and task, so no task sorts more of a group than one task has read.
    """
    if k > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        # A task that is run again has the same number, whatever the order of its rows.
        parts = Window.partitionBy(*group, F.col(_TASK)).orderBy(*order)
        cut = df.withColumn(_TASK, F.spark_partition_id()).withColumn(rank, F.row_number().over(parts))
        df = cut.filter(F.col(rank) <= k).drop(_TASK, rank)
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col(rank) <= k)


def share_of_total(df: DataFrame, measure: str, *, name: str = "share_pct", digits: int = 1) -> DataFrame:
    """Add each row's percentage of the column total.

    The total is a scalar subquery, not a window over everything, so rows stay where they are. The subquery reuses the
    shuffle of an aggregated ``df``, so its input is scanned once.
    """
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(name, percent_of(F.col(measure), total, digits))


def change_over_periods(
    df: DataFrame,
    period: str,
    changes: Mapping[str, str],
    *,
    by: Sequence[str],
    digits: int = 1,
    adjacent_only: bool = False,
) -> DataFrame:
    """Add the percent change of columns (measure -> new column) against the previous period in the data.

    The first period has no predecessor and gets null. A row without a period gets null and is no predecessor. Periods
    may be missing; with ``adjacent_only`` a change across a gap is null too. ``by`` has to be stated: with an empty one all
    periods meet in one task, which suits only what was aggregated to a row per period.
    """
    w = Window.partitionBy(*by).orderBy(F.asc_nulls_last(period))
    out = {}
    for measure, name in changes.items():
        change = percent_change(F.col(measure), F.lag(measure).over(w), digits)
        change = F.when(F.col(period).isNotNull(), change)
        if adjacent_only:
            change = F.when(F.col(period) - F.lag(period).over(w) == 1, change)
        out[name] = change
    return df.withColumns(out)
