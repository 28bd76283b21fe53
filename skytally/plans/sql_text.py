"""Six of the reports as SQL text, for users who query the ``flights`` view.

They must agree with the DataFrame reports (``tests/test_sql_text.py``). ``{flights}`` is filled in by ``spark.sql``
with the DataFrame passed to it; replace it with the name of a view to run a text by hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skytally.functions.columns import CAUSES

_CAUSE_SUMS = ", ".join(f"round(sum({c}), 0) AS {c.lower()}_min" for c in CAUSES)

SQL_REPORTS = {
    "volume_by_carrier": """
        FROM {flights}
        |> AGGREGATE count(*) AS total_flights GROUP BY OP_CARRIER
        |> ORDER BY total_flights DESC, OP_CARRIER NULLS LAST
        |> LIMIT {limit}
    """,
    "delay_by_carrier": """
        FROM {flights}
        |> WHERE ARR_DELAY > 0
        |> AGGREGATE count(*) AS delayed_flights,
                     round(avg(ARR_DELAY), 2) AS avg_delay_min,
                     round(max(ARR_DELAY), 2) AS max_delay_min
           GROUP BY OP_CARRIER
        |> ORDER BY avg_delay_min DESC, OP_CARRIER NULLS LAST
        |> LIMIT {limit}
    """,
    "cause_totals": f"FROM {{flights}} |> AGGREGATE {_CAUSE_SUMS}",
    "worst_origins": """
        FROM {flights}
        |> WHERE DEP_DELAY > 0
        |> AGGREGATE count(*) AS delayed_departures,
                     round(avg(DEP_DELAY), 2) AS avg_dep_delay_min
           GROUP BY ORIGIN
        |> WHERE delayed_departures > {min_support}
        |> ORDER BY avg_dep_delay_min DESC, ORIGIN NULLS LAST
        |> LIMIT {limit}
    """,
    "cancel_reasons": """
        FROM {flights}
        |> WHERE CANCELLED = 1
        |> AGGREGATE count(*) AS cancelled_flights GROUP BY CANCELLATION_CODE
        |> ORDER BY cancelled_flights DESC, CANCELLATION_CODE NULLS LAST
    """,
    "monthly_trend": """
        FROM {flights}
        |> WHERE ARR_DELAY > 0
        |> AGGREGATE round(avg(ARR_DELAY), 2) AS avg_delay_min GROUP BY month(FL_DATE) AS month
        |> ORDER BY month
    """,
}


def sql_report(flights: DataFrame, name: str, *, limit: int = 10, min_support: int = 1000) -> DataFrame:
    """Run one of the texts over ``flights``."""
    return flights.sparkSession.sql(SQL_REPORTS[name], flights=flights, limit=limit, min_support=min_support)


def sql_on_view(
    spark: SparkSession, name: str, *, view: str = "flights", limit: int = 10, min_support: int = 1000
) -> DataFrame:
    """Run one of the texts on a registered view, by its name in the text."""
    text = SQL_REPORTS[name].format(flights=view, limit=int(limit), min_support=int(min_support))
    return spark.sql(text)


def register_view(flights: DataFrame, name: str = "flights") -> None:
    """Make the flights available to ``spark.sql`` under a name."""
    flights.createOrReplaceTempView(name)
