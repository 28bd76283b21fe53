"""Parquet output: landed flights and published reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.functions.columns import has_marked
from skytally.functions.measures import measures_of
from skytally.plans import reports
from skytally.plans.rollup import rollup_flights

Report = Callable[[DataFrame], DataFrame]

ROLLUP = "flight_rollup"

# Stands in a folder of staged tables while they are all of one run.
DONE = "_PUBLISHED"

# The tables published by default, by folder name.
PUBLISHED: dict[str, Report] = {
    "avg_delay": reports.delay_by_group,
    "worst_airports": reports.worst_groups,
    "monthly_trend": reports.monthly_trend,
}


def land_flights(flights: DataFrame, path: str, *, rebalance: bool = True, only_years_in_it: bool = False) -> None:
    """Write flights as Parquet partitioned by year, replacing what is there, or ``only_years_in_it``: the years of the given
    flights are replaced and the files of the others stay as they are, so one more year costs one year.

    Text is parsed once here, joins are made once here, and later reports read single columns. The rows are shuffled by
    year first, and adaptive execution cuts large years into several files and merges small ones; otherwise every task
    would write a file for each year that it meets. Input that comes in one file per year needs no shuffle: there
    ``rebalance=False`` saves it.
    """
    out = flights if has_marked(flights, "year") else flights.withColumn("year", F.year("FL_DATE"))
    if rebalance:
        out = out.hint("rebalance", F.col("year"))
    mode = "dynamic" if only_years_in_it else "static"
    out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("year").parquet(path)


def publish_reports(
    flights: DataFrame,
    path: str,
    tables: Mapping[str, Report] | None = None,
    *,
    one_scan: bool = True,
    staged: bool = False,
) -> None:
    """Write every report to ``path/<name>``, in full and replacing what is there.

    With ``one_scan`` the flights are rolled up once into ``path/flight_rollup``, a table, and the reports read that; those
    that need more than a rollup has read the flights. Tasks lost later then repeat work on the small table, not on the
    flights. Nothing is written before every report has a plan. The rollup's name is not free for a report.

    ``staged`` writes all tables beside the published ones first and moves them into their places when all are complete, so a
    run that dies while it writes leaves the old tables whole. While tables are moved, the file ``path/_PUBLISHED`` is missing;
    readers that need tables of one run wait for it.
    """
    tables = PUBLISHED if tables is None else tables
    if ROLLUP in tables:
        raise ValueError(f"{ROLLUP} is the name of the rolled-up table")
    goal, spark = path.rstrip("/"), flights.sparkSession
    root = f"{goal}/_staging-{uuid.uuid4().hex}" if staged else goal
    rolled = rollup_flights(flights) if one_scan and not measures_of(flights).rolled_up else None
    plans, from_rollup = {}, []
    for name, report in tables.items():
        try:
            plans[name] = report(flights if rolled is None else rolled)
            from_rollup += [name] if rolled is not None else []
        except (AnalysisException, ValueError):
            if rolled is None:
                raise
            plans[name] = report(flights)
    if from_rollup:
        rolled.write.mode("overwrite").parquet(f"{root}/{ROLLUP}")
        landed = spark.read.parquet(f"{root}/{ROLLUP}")
        plans |= {name: tables[name](landed) for name in from_rollup}
    for name, plan in plans.items():
        plan.write.mode("overwrite").parquet(f"{root}/{name}")
    if staged:
        _move_into_place(spark, root, goal)


def _move_into_place(spark: SparkSession, staging: str, goal: str) -> None:
    """Swap the tables in the staging folder in. Only names change: no data is copied."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path
    files = place(goal).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = place(f"{goal}/{DONE}")
    files.delete(done, False)
    for table in files.listStatus(place(staging)):
        name = table.getPath().getName()
        files.delete(place(f"{goal}/{name}"), True)
        if not files.rename(table.getPath(), place(f"{goal}/{name}")):
            raise OSError(f"{name} could not be moved out of {staging}")
    files.delete(place(staging), True)
    files.create(done, True).close()
