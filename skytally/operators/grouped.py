"""Grouped aggregates: filter, group, aggregate, keep supported groups, order, limit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped_report(
    df: DataFrame,
    keys: Mapping[str, Column] | Sequence[str],
    measures: Mapping[str, Column],
    *,
    where: Column | None = None,
    having: Column | None = None,
    order: Sequence[Column] = (),
    limit: int | None = None,
) -> DataFrame:
    """One row per key combination.

    Partial aggregation shrinks every input task to its number of groups before the only shuffle, so a key that holds
    a third of all rows costs each task one row, like any other key. ``order`` directly under ``limit`` becomes a
    top-k without a global sort.
    """
    if not isinstance(keys, Mapping):
        keys = {k: F.col(k) for k in keys}
    if where is not None:
        df = df.filter(where)
    out = df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(*[c.alias(n) for n, c in measures.items()])
    if having is not None:
        out = out.filter(having)
    if order:
        out = out.orderBy(*order)
    return out if limit is None else out.limit(limit)


def wide_to_long(df: DataFrame, ids: Sequence[str], columns: Mapping[str, str], name: str, value: str) -> DataFrame:
    """Turn the given columns (column -> label) into rows of ``name`` and ``value``. Meant for aggregated rows: the
    sums are taken wide, in one pass, and only the result is stretched."""
    wide = df.select(*ids, *[F.col(c).alias(label) for c, label in columns.items()])
    return wide.unpivot(list(ids), list(columns.values()), name, value)
