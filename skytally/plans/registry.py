"""The queries that run on the order tables: each a report with the flight columns it reads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.functions.columns import CAUSES
from skytally.plans import charts, reports
from skytally.operators import top_k_per_group
from skytally.plans.rollup import merge_rollups, rollup_flights
from skytally.plans.sql_text import register_view, sql_on_view, sql_report
from skytally.sinks.parquet import land_flights, publish_reports
from skytally.sinks.workspace import working_folder
from skytally.sources.binding import bind_flights
from skytally.sources.csv_folder import load_flight_lines, load_flights, parse_lines
from skytally.sources.landed import read_landed
from skytally.sources.schema import FLIGHT_COLUMNS

CARRIER_DELAYS = ("OP_CARRIER", "ARR_DELAY")
ORIGIN_DELAYS = ("ORIGIN", "DEP_DELAY")
REASON = ("CANCELLED", "CANCELLATION_CODE")
MONTH_DELAYS = ("FL_DATE", "ARR_DELAY")
YEAR_FIGURES = ("FL_DATE", "ARR_DELAY", "CANCELLED")
YEAR_CAUSES = ("FL_DATE", *CAUSES)
HEADLINE = ("FL_DATE", "OP_CARRIER", "ORIGIN", "ARR_DELAY", "DEP_DELAY", *REASON, *CAUSES)

# Routes of the order tables are thinner than real ones; the report's own default is 50.
ROUTE_SUPPORT = 5
PICKED_YEARS = (1997, 1998)
LATER_YEAR = 1998
BROKEN_DAY = 7
WORST_FLIGHTS = 1200


@dataclass(frozen=True)
class FlightQuery:
    """A report over the bound flights."""

    report: Callable[[DataFrame], DataFrame]
    columns: tuple[str, ...]

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.report(bind_flights(spark, sf_dir, self.columns))


@dataclass(frozen=True)
class LineQuery:
    """A report by way of raw text: every flight is written as a line, with blanks around its values and a header line
    after each flight of a 13th; then the lines are parsed, for the report's columns only."""

    report: Callable[[DataFrame], DataFrame]
    columns: tuple[str, ...]

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        flights = bind_flights(spark, sf_dir, dict.fromkeys(["FL_DATE", *self.columns]))
        header = F.lit(",".join(FLIGHT_COLUMNS))
        # Columns that are not asked for are empty; what stands between two others is one constant.
        parts, between = [], ""
        for i, c in enumerate(FLIGHT_COLUMNS):
            between += "," if i else ""
            if c in flights.columns:
                parts += [F.lit(f"{between} "), F.coalesce(F.col(c).cast("string"), F.lit(""))]
                between = " "
        line = F.concat(*parts, F.lit(between))
        after = F.when(F.dayofmonth("FL_DATE") == 13, F.array(line, header)).otherwise(F.array(line))
        lines = flights.select(F.explode(after).alias("value"))
        return self.report(parse_lines(lines, list(FLIGHT_COLUMNS), columns=self.columns))


@dataclass(frozen=True)
class CsvQuery:
    """A report by way of files: all flights, with all columns, are written as headed CSV files to the shared folder, a file
    per task, and read back as any folder is, with the header found in it."""

    report: Callable[[DataFrame], DataFrame]

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = working_folder(spark, "flights-csv")
        bind_flights(spark, sf_dir).write.option("header", True).csv(folder)
        return self.report(load_flights(spark, folder))


@dataclass(frozen=True)
class BadLinesQuery:
    """How many lines per carrier do not parse, and how many of their departure delays do, by either way of reading. Before the
    flights are written as CSV, those of one day of the month get a word for that delay, and carriers a comma, so quotes."""

    load: Callable[..., DataFrame]

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        folder, landed = working_folder(spark, "flights-csv"), working_folder(spark, "landed")
        flights = bind_flights(spark, sf_dir)
        broken = F.when(F.dayofmonth("FL_DATE") == BROKEN_DAY, F.lit("late")).otherwise(F.col("DEP_DELAY").cast("string"))
        changed = flights.withColumns({"DEP_DELAY": broken, "OP_CARRIER": F.concat("OP_CARRIER", F.lit(", Inc."))})
        changed.write.option("header", True).csv(folder)
        # Bad lines are told when values are read, so the flights are landed first.
        land_flights(self.load(spark, folder, keep_bad=True), landed)
        return (
            read_landed(spark, landed, keep_bad=True)
            .groupBy("OP_CARRIER")
            .agg(F.count("*").alias("total_flights"), F.count("_bad").alias("bad_lines"), F.count("DEP_DELAY").alias("known_delays"))
        )


@dataclass(frozen=True)
class PublishedQuery:
    """A published table: all default reports are written to the shared folder from one scan, and one is read back."""

    table: str
    staged: bool = False

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = working_folder(spark, "published")
        publish_reports(bind_flights(spark, sf_dir), folder, staged=self.staged)
        return spark.read.parquet(f"{folder}/{self.table}")


@dataclass(frozen=True)
class LandedQuery:
    """A report on flights that were landed as Parquet in the shared folder: up to a year first, then the years from it on, which
    replaces that year's rows and leaves the years before as they are."""

    report: Callable[[DataFrame], DataFrame]

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = working_folder(spark, "landed")
        flights = bind_flights(spark, sf_dir)
        year = F.coalesce(F.year("FL_DATE"), F.lit(0))
        land_flights(flights.filter(year <= LATER_YEAR), folder)
        land_flights(flights.filter(year >= LATER_YEAR), folder, only_years_in_it=True)
        return self.report(read_landed(spark, folder))


def merged_rollup(flights: DataFrame) -> DataFrame:
    """The rollup of all flights, merged from those of earlier and of later years."""
    year = F.coalesce(F.year("FL_DATE"), F.lit(0))
    return merge_rollups(rollup_flights(flights.filter(year < LATER_YEAR)), rollup_flights(flights.filter(year >= LATER_YEAR)))


def worst_flights(flights: DataFrame) -> DataFrame:
    """The flights with the longest arrival delays of every carrier, more than Spark cuts groups to by itself."""
    order = [F.desc_nulls_last("ARR_DELAY"), *[F.asc_nulls_last(c) for c in ("FL_DATE", "ORIGIN", "DEST", "DEP_DELAY")]]
    return top_k_per_group(flights.filter("ARR_DELAY is not null"), ["OP_CARRIER"], order, WORST_FLIGHTS)


@dataclass(frozen=True)
class ViewQuery:
    """A SQL text on the flights registered as a view."""

    text: str
    columns: tuple[str, ...]

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        view = f"flights_for_{self.text}"
        register_view(bind_flights(spark, sf_dir, self.columns), view)
        return sql_on_view(spark, self.text, view=view)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flight_count": FlightQuery(reports.flight_count, ()),
    "volume_by_carrier": FlightQuery(lambda f: reports.volume_by_group(f, limit=10), ("OP_CARRIER",)),
    "delay_by_carrier": FlightQuery(reports.delay_by_group, CARRIER_DELAYS),
    "delay_by_carrier_all_flights": FlightQuery(
        lambda f: reports.delay_by_group(f, only_positive=False), CARRIER_DELAYS
    ),
    "delay_by_carrier_from_lines": LineQuery(reports.delay_by_group, CARRIER_DELAYS),
    "volume_by_carrier_from_lines": LineQuery(lambda f: reports.volume_by_group(f, limit=10), ("OP_CARRIER",)),
    "cancel_reasons_from_lines": LineQuery(lambda f: reports.reason_counts(f, drop_blank=True, decode=True), REASON),
    "delay_by_carrier_from_csv": CsvQuery(reports.delay_by_group),
    "year_summary_from_csv": CsvQuery(reports.year_summary),
    "bad_lines_from_csv": BadLinesQuery(load_flights),
    "bad_lines_from_lines": BadLinesQuery(load_flight_lines),
    "published_avg_delay": PublishedQuery("avg_delay"),
    "published_worst_airports": PublishedQuery("worst_airports", staged=True),
    "published_monthly_trend": PublishedQuery("monthly_trend"),
    "published_flight_rollup": PublishedQuery("flight_rollup", staged=True),
    "year_summary_landed": LandedQuery(reports.year_summary),
    "flight_rollup_merged": FlightQuery(merged_rollup, FLIGHT_COLUMNS),
    "worst_flights_per_carrier": FlightQuery(worst_flights, ("FL_DATE", *CARRIER_DELAYS, "ORIGIN", "DEST", "DEP_DELAY")),
    "cause_totals": FlightQuery(reports.cause_totals, tuple(CAUSES)),
    "worst_origins": FlightQuery(lambda f: reports.worst_groups(f, limit=10), ORIGIN_DELAYS),
    "cancel_reasons": FlightQuery(reports.reason_counts, REASON),
    "cancel_reasons_decoded": FlightQuery(lambda f: reports.reason_counts(f, drop_blank=True, decode=True), REASON),
    "monthly_trend": FlightQuery(reports.monthly_trend, MONTH_DELAYS),
    "monthly_trend_labelled": FlightQuery(lambda f: reports.monthly_trend(f, label=True), MONTH_DELAYS),
    "top_routes_per_carrier": FlightQuery(
        lambda f: reports.top_routes(f, min_support=ROUTE_SUPPORT), (*CARRIER_DELAYS, "ORIGIN", "DEST")
    ),
    "year_summary": FlightQuery(reports.year_summary, YEAR_FIGURES),
    "year_cause_minutes": FlightQuery(reports.year_cause_minutes, YEAR_CAUSES),
    "top_carriers_per_year": FlightQuery(reports.top_carriers_per_year, ("FL_DATE", *CARRIER_DELAYS)),
    "top_carriers_picked_years": FlightQuery(
        lambda f: reports.top_carriers_per_year(f, years=PICKED_YEARS), ("FL_DATE", *CARRIER_DELAYS)
    ),
    "cause_share": FlightQuery(reports.cause_share, tuple(CAUSES)),
    "cancel_reason_share": FlightQuery(reports.reason_share, REASON),
    "cause_yoy_change": FlightQuery(reports.cause_change, YEAR_CAUSES),
    "cause_yoy_change_millions": FlightQuery(
        lambda f: reports.cause_change(f, unit=1e6, unit_digits=2), YEAR_CAUSES
    ),
    "year_summary_change": FlightQuery(reports.year_summary_change, YEAR_FIGURES),
    "headline_extremes": FlightQuery(reports.headline_extremes, HEADLINE),
    "chart_volume": FlightQuery(charts.volume_in_millions, ("OP_CARRIER",)),
    "chart_year_overview": FlightQuery(charts.year_overview, YEAR_FIGURES),
    "chart_month_range": FlightQuery(
        lambda f: charts.value_range(reports.monthly_trend(f), "avg_delay_min"), MONTH_DELAYS
    ),
    "flight_rollup": FlightQuery(rollup_flights, FLIGHT_COLUMNS),
    "sql_volume_by_carrier": FlightQuery(lambda f: sql_report(f, "volume_by_carrier"), ("OP_CARRIER",)),
    "sql_delay_by_carrier": FlightQuery(lambda f: sql_report(f, "delay_by_carrier"), CARRIER_DELAYS),
    "sql_cause_totals": FlightQuery(lambda f: sql_report(f, "cause_totals"), tuple(CAUSES)),
    "sql_worst_origins": FlightQuery(lambda f: sql_report(f, "worst_origins"), ORIGIN_DELAYS),
    "sql_cancel_reasons": FlightQuery(lambda f: sql_report(f, "cancel_reasons"), REASON),
    "sql_monthly_trend": FlightQuery(lambda f: sql_report(f, "monthly_trend"), MONTH_DELAYS),
    "sql_view_monthly_trend": ViewQuery("monthly_trend", MONTH_DELAYS),
    "sql_view_worst_origins": ViewQuery("worst_origins", ORIGIN_DELAYS),
}
