"""Punctuality and cancellation reports over flight tables of any size, on Spark."""

from skytally.plans import reports
from skytally.plans.charts import chart_frames
from skytally.plans.rollup import merge_rollups, rollup_flights
from skytally.plans.sql_text import register_view, sql_on_view, sql_report
from skytally.sinks import land_flights, publish_reports
from skytally.sources import bind_flights, load_flight_lines, load_flights, read_landed

__all__ = [
    "bind_flights",
    "chart_frames",
    "land_flights",
    "load_flight_lines",
    "load_flights",
    "merge_rollups",
    "publish_reports",
    "read_landed",
    "register_view",
    "reports",
    "rollup_flights",
    "sql_on_view",
    "sql_report",
]
