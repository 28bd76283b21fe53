"""A flights-shaped view of the normalised order tables, used for tests and benchmarks.

One row per ``lineitem`` row. The other tables hang on it by left joins on their keys, so no join adds or drops a row,
and a join whose columns nobody asked for is left out without changing the result. Which columns a report needs is
declared in ``plans.registry``: counting by carrier joins one table instead of seven.

No side is broadcast by hint. Spark broadcasts a side when its size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides otherwise; adaptive execution splits the partition of a
key that holds too many rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.sources.schema import FLIGHT_COLUMNS

# The columns used of each table. Declared, so opening a table runs no job to find its schema.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_brand string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

# What needs no other table, narrowed before the joins move it. ``flown`` is the date of a flight that took place and
# null otherwise; delays are differences to it, so a filter on a delay drops the other rows before the join. The
# condition is null-safe, hence never null, which lets a filter on CANCELLED turn back into it and reach the scan.
FACTS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "cast(l_shipdate as date) as FL_DATE",
    "if(l_returnflag <=> 'R', null, cast(l_shipdate as date)) as flown",
    "if(l_returnflag <=> 'R', 1.0D, 0.0D) as CANCELLED",
    "if(l_returnflag <=> 'R', decode(l_linenumber, 1, 'A', 2, 'B', 3, 'C', 4, 'D'), null) as CANCELLATION_CODE",
)

# The line numbers whose delay goes to each cause, from 15 days on.
CAUSE_LINES = {
    "CARRIER_DELAY": "1, 6",
    "WEATHER_DELAY": "2",
    "NAS_DELAY": "3",
    "SECURITY_DELAY": "4",
    "LATE_AIRCRAFT_DELAY": "5, 7",
}

LAG = "datediff(flown, ordered)"
DELAYS = {
    "ARR_DELAY": f"cast({LAG} as double)",
    "DEP_DELAY": f"cast({LAG} - l_linenumber as double)",
    **{
        cause: f"if({LAG} >= 15, if(l_linenumber in ({lines}), cast({LAG} as double), 0.0D), null)"
        for cause, lines in CAUSE_LINES.items()
    },
}


def bind_flights(spark: SparkSession, sf_dir: str, columns: Iterable[str] = FLIGHT_COLUMNS) -> DataFrame:
    """The order tables in ``sf_dir`` as flights, with the given columns and only the joins these need."""
    wanted = list(columns)
    unknown = [c for c in wanted if c not in FLIGHT_COLUMNS]
    if unknown:
        raise ValueError(f"no such flight column: {', '.join(unknown)}")

    def table(name: str) -> DataFrame:
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    flights = table("lineitem").selectExpr(*FACTS)
    if "DEST" in wanted or any(c in DELAYS for c in wanted):
        orders = table("orders").selectExpr("o_orderkey", "o_custkey", "cast(o_orderdate as date) as ordered")
        if "DEST" in wanted:
            # Small tables meet first: nations and regions join customers, customers join orders, and only then lineitem,
            # so nothing of lineitem's size is shuffled by customer or by one of 25 nations.
            nations = table("nation").selectExpr("n_nationkey as dest_key", "n_regionkey")
            regions = _attach(nations, table("region"), "n_regionkey", "r_regionkey").selectExpr("dest_key", "r_name as DEST")
            customers = _attach(table("customer"), regions, "c_nationkey", "dest_key").selectExpr("c_custkey", "DEST")
            orders = _attach(orders, customers, "o_custkey", "c_custkey")
        flights = _attach(flights, orders, "l_orderkey", "o_orderkey")
    if "OP_CARRIER" in wanted:
        carriers = table("part").selectExpr("p_partkey", "p_brand as OP_CARRIER")
        flights = _attach(flights, carriers, "l_partkey", "p_partkey")
    if "ORIGIN" in wanted:
        origins = table("nation").selectExpr("n_nationkey as origin_key", "n_name as ORIGIN")
        suppliers = _attach(table("supplier"), origins, "s_nationkey", "origin_key").selectExpr("s_suppkey", "ORIGIN")
        flights = _attach(flights, suppliers, "l_suppkey", "s_suppkey")
    return flights.selectExpr(*[f"{DELAYS[c]} as {c}" if c in DELAYS else c for c in wanted])


def _attach(df: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    return df.join(other, F.expr(f"{key} = {other_key}"), "left")
