"""The physical plans stay the ones wanted: what is read, where rows are dropped, how often data is shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from skytally import bind_flights, load_flights, read_landed, reports, rollup_flights
from skytally.operators import top_k_per_group
from skytally.plans.registry import QUERIES
from skytally.sinks import land_flights

SF001 = "/root/testdata/sf0.001"


def plan_of(df):
    """The physical plan before adaptive execution; long lines uncut."""
    session, name = df.sparkSession, "spark.sql.maxMetadataStringLength"
    before = session.conf.get(name)
    session.conf.set(name, "2000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        session.conf.set(name, before)


def final_plan_of(df):
    df.collect()
    return plan_of(df)


@pytest.fixture()
def no_broadcast(spark):
    """Joins as on tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed"))
    land_flights(bind_flights(spark, SF001), path)
    return read_landed(spark, path)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF001))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit"):
        assert operator not in plan


@pytest.mark.parametrize(
    "name, joins",
    [
        ("flight_count", 0),
        ("cancel_reasons", 0),
        ("volume_by_carrier", 1),
        ("cause_totals", 1),
        ("delay_by_carrier", 2),
        ("worst_origins", 3),
        ("top_routes_per_carrier", 7),
    ],
)
def test_only_needed_joins(spark, name, joins):
    plan = plan_of(QUERIES[name](spark, SF001))
    assert len(re.findall(r"BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin", plan)) == joins


def test_delay_filter_drops_rows_before_the_join(spark, no_broadcast):
    plan = plan_of(QUERIES["delay_by_carrier"](spark, SF001))
    # Both sides of the join with orders are filtered below the shuffle, and the filter made it an inner join.
    assert re.search(r"SortMergeJoin \[l_orderkey#\d+L\], \[o_orderkey#\d+L\], Inner, \(datediff", plan)
    facts = plan[plan.index("hashpartitioning(l_orderkey") :]
    assert re.search(r"Filter .*l_returnflag.*isnotnull", facts[: facts.index("FileScan")])


def test_cancel_filter_reaches_the_scan(spark):
    assert "PushedFilters: [EqualNullSafe(l_returnflag,R)]" in plan_of(QUERIES["cancel_reasons"](spark, SF001))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_results_hold_without_broadcast(spark, name, no_broadcast):
    shuffled = QUERIES[name](spark, SF001).collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    broadcast = QUERIES[name](spark, SF001).collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, broadcast))


def test_columns_are_pruned_and_filters_pushed_on_landed_flights(landed):
    plan = plan_of(reports.delay_by_group(landed))
    assert "ReadSchema: struct<OP_CARRIER:string,ARR_DELAY:double>" in plan
    assert "GreaterThan(ARR_DELAY,0.0)" in plan
    assert plan.count("hashpartitioning") == 1


def test_year_filter_prunes_folders(landed):
    plan = plan_of(reports.top_carriers_per_year(landed, years=[1997]))
    assert re.search(r"PartitionFilters: \[isnotnull\(year#\d+\), \(year#\d+ = 1997\)\]", plan)
    assert "FL_DATE" not in plan[plan.index("ReadSchema") :]


def test_csv_scan_is_pruned(spark, fixture_folder):
    plan = plan_of(reports.delay_by_group(load_flights(spark, fixture_folder)))
    assert "ReadSchema: struct<OP_CARRIER:string,ARR_DELAY:double>" in plan
    # The filter stands right on the scan: text has no filter to push, as NaN has to become null first.
    assert re.search(r"Filter .*ARR_DELAY.*\n.*FileScan csv", plan)


def test_lineitem_joins_three_tables_and_is_never_shuffled_by_nation(spark, no_broadcast):
    plan = plan_of(QUERIES["top_routes_per_carrier"](spark, SF001))
    for key in ("s_nationkey", "c_nationkey"):
        below = plan[plan.index(f"hashpartitioning({key}") :]
        assert "l_orderkey" not in below[: below.index("FileScan")]
    assert len(re.findall(r"Exchange hashpartitioning\(l_\w+key", plan)) == 3


def test_limit_is_a_top_k(landed):
    plan = plan_of(reports.worst_groups(landed, limit=10))
    assert "TakeOrderedAndProject(limit=10" in plan and "rangepartitioning" not in plan


def test_groups_are_cut_before_the_rank_shuffle(landed):
    plan = plan_of(reports.top_routes(landed))
    assert plan.count("WindowGroupLimit") == 2
    below_shuffle = plan[plan.index("hashpartitioning(OP_CARRIER") :]
    assert "row_number(), 3, Partial" in below_shuffle


def test_share_scans_once(landed):
    plan = final_plan_of(reports.reason_share(landed))
    assert "ReusedExchange" in plan[: plan.index("Initial Plan")]
    assert "Window" not in plan


@pytest.mark.parametrize(
    "report", [reports.headline_extremes, reports.cause_share, reports.cause_change, reports.year_summary_change]
)
def test_one_scan(landed, report):
    assert plan_of(report(landed)).count("FileScan") == 1


def test_rollup_is_one_scan_and_one_shuffle(landed):
    plan = plan_of(rollup_flights(landed))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_hot_key_is_split(spark, no_broadcast, tmp_path):
    """A part that holds a third of all lines: its join partition is split, and counts stay right."""
    lines = spark.range(300_000).selectExpr(
        "id as l_orderkey",
        "if(id % 3 = 0, 7, id % 1000) as l_partkey",
        "1L as l_suppkey",
        "1 as l_linenumber",
        "'N' as l_returnflag",
        "timestamp_ntz'2000-01-01 00:00:00' as l_shipdate",
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    parts = spark.range(1000).selectExpr("id as p_partkey", "concat('B', id % 4) as p_brand")
    parts.write.parquet(str(tmp_path / "part.parquet"))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        volume = reports.volume_by_group(bind_flights(spark, str(tmp_path), ["OP_CARRIER"]))
        rows = volume.collect()
        assert "skew=true" in plan_of(volume)
    finally:
        for key in settings:
            spark.conf.unset(key)
    want = {f"B{b}": 0 for b in range(4)}
    for i in range(300_000):
        want[f"B{(7 if i % 3 == 0 else i % 1000) % 4}"] += 1
    assert {r.OP_CARRIER: r.total_flights for r in rows} == want


def test_large_k_sorts_no_whole_group(spark):
    rows = spark.range(30_000, numPartitions=6).selectExpr("if(id % 3 = 0, 0, id % 40) as g", "id * 7919 % 10007 as v", "id")
    best = top_k_per_group(rows, ["g"], [F.desc("v"), F.asc("id")], 2000)
    plan = plan_of(best)
    # First by group and task, then, from the rows that are left, by group.
    assert len(re.findall(r"Exchange hashpartitioning\(g#\d+L?, __input_task#", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(g#", plan)) == 2
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (-r.v, r.id)):
        if len(group := want.setdefault(r.g, [])) < 2000:
            group.append((r.g, r.v, r.id, len(group) + 1))
    assert sorted(map(tuple, best.collect())) == sorted(x for group in want.values() for x in group)
