"""Time the reports on a folder of wide CSV files, the form in which flights arrive.

    python bench_csv.py FOLDER [copies]

The bound flights of ``BENCH_SF_DIR`` are written ``copies`` times (22 by default, 13.2 million rows at sf0.1) as CSV
with 27 columns, one folder of files, to a new folder in ``FOLDER``, which all executors have to reach. Then three ways to get seven reports and three
published tables are timed: every report from the CSV files; from a landed Parquet table; from one rollup of the CSV
files.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bench import build_session
from skytally import bind_flights, load_flights, publish_reports, read_landed, reports, rollup_flights
from skytally.sinks import land_flights
from skytally.sources import FLIGHT_COLUMNS

SEVEN = {
    "volume": reports.volume_by_group,
    "delay": reports.delay_by_group,
    "causes": reports.cause_totals,
    "origins": reports.worst_groups,
    "reasons": reports.reason_counts,
    "months": reports.monthly_trend,
    "routes": reports.top_routes,
}


def write_csv(flights: DataFrame, copies: int, path: str) -> None:
    fillers = [F.lit(f"filler{i}").alias(f"FILLER_{i}") for i in range(27 - len(FLIGHT_COLUMNS))]
    copied = flights.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    copied.select(*FLIGHT_COLUMNS[:4], *fillers, *FLIGHT_COLUMNS[4:]).write.option("header", True).csv(path)


def all_reports(flights: DataFrame) -> None:
    for report in SEVEN.values():
        report(flights).write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 2)


def main() -> None:
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 22
    spark = build_session(os.environ.get("BENCH_CPUS", "8"))
    root = f"{sys.argv[1].rstrip('/')}/flights-{uuid.uuid4().hex}"
    flights = bind_flights(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    # Spread the single input file over all cores before multiplying it.
    write_csv(flights.repartition(16), copies, f"{root}/csv")
    size = spark.read.format("binaryFile").load(f"{root}/csv").agg({"length": "sum"}).first()[0]

    def from_csv() -> None:
        loaded = load_flights(spark, f"{root}/csv")
        all_reports(loaded)
        publish_reports(loaded, f"{root}/from_csv", one_scan=False)

    def from_landed() -> None:
        land_flights(load_flights(spark, f"{root}/csv"), f"{root}/landed")
        landed = read_landed(spark, f"{root}/landed")
        all_reports(landed)
        publish_reports(landed, f"{root}/from_landed", one_scan=False)

    def from_rollup() -> None:
        rollup_flights(load_flights(spark, f"{root}/csv")).write.parquet(f"{root}/rollup")
        rolled = spark.read.parquet(f"{root}/rollup")
        all_reports(rolled)
        publish_reports(rolled, f"{root}/from_rollup")

    line = {"rows": load_flights(spark, f"{root}/csv").count(), "csv_mb": round(size / 1e6)}
    for name, work in {"from_csv": from_csv, "from_landed": from_landed, "from_rollup": from_rollup}.items():
        line[f"{name}_sec"] = timed(work)
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
