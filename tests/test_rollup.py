"""Reports from the rollup equal reports from the flights."""

import pytest

from skytally import bind_flights, merge_rollups, reports, rollup_flights
from skytally.plans.charts import chart_frames, volume_in_millions, year_overview

REPORTS = {
    "flight_count": reports.flight_count,
    "volume_by_group": reports.volume_by_group,
    "delay_by_group": reports.delay_by_group,
    "departure_delay_by_origin": lambda f: reports.delay_by_group(f, ["ORIGIN"], delay="DEP_DELAY"),
    "cause_totals": reports.cause_totals,
    "worst_groups": lambda f: reports.worst_groups(f, min_support=20),
    "reason_counts": lambda f: reports.reason_counts(f, decode=True),
    "reason_counts_without_blank": lambda f: reports.reason_counts(f, drop_blank=True),
    "reason_share": reports.reason_share,
    "monthly_trend": lambda f: reports.monthly_trend(f, label=True),
    "top_routes": lambda f: reports.top_routes(f, min_support=5),
    "top_carriers_per_year": lambda f: reports.top_carriers_per_year(f, years=[1996, 1999]),
    "year_summary": reports.year_summary,
    "year_summary_change": reports.year_summary_change,
    "year_cause_minutes": reports.year_cause_minutes,
    "cause_share": reports.cause_share,
    "cause_change": reports.cause_change,
    "headline_extremes": lambda f: reports.headline_extremes(f, min_support=20),
    "volume_in_millions": volume_in_millions,
    "year_overview": year_overview,
}


@pytest.fixture(scope="module")
def both(spark):
    flights = bind_flights(spark, "/root/testdata/sf0.001")
    return flights, rollup_flights(flights).cache()


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_same_report(both, name):
    flights, rolled = (REPORTS[name](f) for f in both)
    assert flights.dtypes == rolled.dtypes
    assert flights.collect() == rolled.collect()


def test_rollup_adds_up(both):
    flights, rolled = both
    totals = rolled.selectExpr("sum(n_flights)", "sum(n_cancelled)", "sum(ARR_DELAY_n)").collect()[0]
    want = flights.selectExpr("count(*)", "count_if(CANCELLED = 1)", "count_if(ARR_DELAY > 0)").collect()[0]
    assert tuple(totals) == tuple(want)


def test_charts(both):
    frames = chart_frames(both[1], years=(1997, 1998))
    assert len(frames) == 10
    assert all(f.count() > 0 for name, f in frames.items() if name != "worst_origins")
    assert {r.year for r in frames["top_carriers"].collect()} == {1997, 1998}


def test_merged_rollups_equal_one_of_all_flights(spark, tmp_path):
    flights = bind_flights(spark, "/root/testdata/sf0.001")
    stored = str(tmp_path / "old")
    rollup_flights(flights.filter("year(FL_DATE) < 1997 or FL_DATE is null")).write.parquet(stored)
    merged = merge_rollups(spark.read.parquet(stored), rollup_flights(flights.filter("year(FL_DATE) >= 1997 and ORIGIN <> 'CHINA'")),
                           rollup_flights(flights.filter("year(FL_DATE) >= 1997 and ORIGIN = 'CHINA'")))
    whole = rollup_flights(flights)
    assert merged.schema.names == whole.schema.names
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
    merged.write.parquet(str(tmp_path / "new"))
    again = spark.read.parquet(str(tmp_path / "new"))
    for report in (reports.delay_by_group, reports.year_summary, reports.headline_extremes, reports.cause_change):
        assert report(again).collect() == report(flights).collect()


def test_flights_and_other_keys_are_not_merged(fixture_flights):
    rollup = rollup_flights(fixture_flights)
    for wrong in (fixture_flights, rollup_flights(fixture_flights, ("year", "month")), rollup.withColumn("more", rollup.year)):
        with pytest.raises(ValueError, match="same keys"):
            merge_rollups(rollup, wrong)
    with pytest.raises(ValueError, match="no rollup"):
        merge_rollups()
