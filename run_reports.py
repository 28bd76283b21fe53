"""Run all reports over a folder of flight files.

    spark-submit --py-files skytally.zip run_reports.py INPUT [--output DIR] [--land DIR] [--api frame|sql|lines]

``INPUT`` holds headed CSV files. They are read once: ``--land`` writes them as Parquet partitioned by year and reads that,
``--output`` rolls them up into ``OUTPUT/flight_rollup`` and the reports read the rollup. At least one of the two is needed.
``--api sql`` runs the SQL texts on a view of the landed flights, so it needs ``--land``; ``--api lines`` reads the files as
text.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from skytally import (
    land_flights,
    load_flight_lines,
    load_flights,
    publish_reports,
    read_landed,
    register_view,
    reports,
    sql_on_view,
)
from skytally.plans.sql_text import SQL_REPORTS

FRAME_REPORTS = {
    "Flights per carrier": reports.volume_by_group,
    "Arrival delay per carrier": reports.delay_by_group,
    "Minutes lost per cause": reports.cause_totals,
    "Share of each cause": reports.cause_share,
    "Worst origins by departure delay": reports.worst_groups,
    "Cancellations per reason": reports.reason_share,
    "Monthly trend": lambda f: reports.monthly_trend(f, label=True),
    "Worst routes per carrier": reports.top_routes,
    "Year summary": reports.year_summary,
    "Change of the year summary": reports.year_summary_change,
    "Minutes per year and cause, in millions": reports.year_cause_minutes,
    "Change of minutes per cause": reports.cause_change,
    "Worst carriers per year": reports.top_carriers_per_year,
    "Headline": reports.headline_extremes,
}


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Punctuality reports over a folder of flight files.")
    parser.add_argument("input", help="folder of headed CSV files")
    parser.add_argument("--output", help="folder for the published tables")
    parser.add_argument("--land", help="folder for the flights as Parquet")
    parser.add_argument("--api", choices=["frame", "sql", "lines"], default="frame")
    parser.add_argument("--show", type=int, default=30, help="rows to print of each report")
    args = parser.parse_args(arguments)
    if not args.land and (args.api == "sql" or not args.output):
        parser.error("give --land (or --output, but not with --api sql), so that the files are read only once")
    return args


def read_input(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    flights = load_flight_lines(spark, args.input) if args.api == "lines" else load_flights(spark, args.input)
    if args.land:
        land_flights(flights, args.land)
        flights = read_landed(spark, args.land)
    return flights


def main(arguments: list[str] | None = None) -> None:
    args = parse_arguments(arguments)
    spark = SparkSession.builder.appName("skytally").getOrCreate()
    flights = read_input(spark, args)
    flights.printSchema()
    source = flights
    if args.output:
        publish_reports(flights, args.output)
        source = spark.read.parquet(f"{args.output.rstrip('/')}/flight_rollup")
    reports.flight_count(source).show()
    if args.api == "sql":
        register_view(flights)
        tables = {name: sql_on_view(spark, name) for name in SQL_REPORTS}
    else:
        tables = {title: report(source) for title, report in FRAME_REPORTS.items()}
    for title, table in tables.items():
        print(title)
        table.show(args.show, truncate=False)


if __name__ == "__main__":
    main()
