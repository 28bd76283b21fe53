"""Landing and publishing."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from skytally import bind_flights, load_flights, publish_reports, read_landed, reports
from skytally.sinks import land_flights


def test_land_and_read_back(spark, fixture_flights, tmp_path):
    for rebalance in (False, True):
        path = str(tmp_path / f"landed-{rebalance}")
        land_flights(fixture_flights, path, rebalance=rebalance)
        landed = read_landed(spark, path)
        assert sorted(map(str, landed.drop("year").collect())) == sorted(map(str, fixture_flights.collect()))
        assert reports.year_summary(landed).collect() == reports.year_summary(fixture_flights).collect()


def test_landed_tables_give_the_same_reports(spark, tmp_path):
    flights = bind_flights(spark, "/root/testdata/sf0.001")
    land_flights(flights, str(tmp_path / "t"))
    landed = read_landed(spark, str(tmp_path / "t"))
    for report in (
        reports.delay_by_group,
        reports.reason_share,
        reports.year_summary,
        reports.top_carriers_per_year,
        reports.cause_change,
        reports.headline_extremes,
    ):
        assert report(landed).collect() == report(flights).collect()


def test_flights_without_a_date_are_landed_too(spark, make_flights, tmp_path):
    land_flights(make_flights({"FL_DATE": None}, {}), str(tmp_path / "t"))
    assert {r.year for r in read_landed(spark, str(tmp_path / "t")).collect()} == {None, 2017}


@pytest.mark.parametrize("one_scan", [True, False])
def test_publish(spark, fixture_flights, tmp_path, one_scan):
    tables = {"avg_delay": reports.delay_by_group, "trend": reports.monthly_trend}
    for _ in range(2):  # the second run replaces the first
        publish_reports(fixture_flights, str(tmp_path), tables, one_scan=one_scan)
    for name, report in tables.items():
        published = spark.read.parquet(str(tmp_path / name))
        assert sorted(published.collect()) == sorted(report(fixture_flights).collect())


def test_default_tables(spark, fixture_flights, tmp_path):
    publish_reports(fixture_flights, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir()} == {"flight_rollup", "avg_delay", "worst_airports", "monthly_trend"}


def test_results_may_lie_in_the_input_folder(spark, tmp_path):
    from fixture_data import write_fixture

    folder = write_fixture(tmp_path)
    publish_reports(load_flights(spark, folder), f"{folder}/output")
    assert load_flights(spark, folder).count() == 11


def test_own_reports_beside_those_of_the_rollup(spark, fixture_flights, tmp_path):
    tables = {
        "trend": reports.monthly_trend,
        "all_delays": lambda f: reports.delay_by_group(f, only_positive=False),
        "by_day": lambda f: f.groupBy("FL_DATE").count(),
    }
    publish_reports(fixture_flights, str(tmp_path), tables)
    for name, report in tables.items():
        assert sorted(spark.read.parquet(str(tmp_path / name)).collect()) == sorted(report(fixture_flights).collect())


def test_nothing_is_written_if_a_report_has_no_plan(fixture_flights, tmp_path):
    tables = {"trend": reports.monthly_trend, "wrong": lambda f: f.groupBy("NO_SUCH_COLUMN").count()}
    with pytest.raises(Exception, match="NO_SUCH_COLUMN"):
        publish_reports(fixture_flights, str(tmp_path), tables)
    with pytest.raises(ValueError, match="flight_rollup"):
        publish_reports(fixture_flights, str(tmp_path), {"flight_rollup": reports.monthly_trend})
    assert not list(tmp_path.iterdir())


def files_of(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*.parquet")}


def test_one_more_year_leaves_the_others_as_they_are(make_flights, spark, tmp_path):
    first = make_flights(*[{"FL_DATE": date(y, 1, d), "ARR_DELAY": float(d)} for y in (2016, 2017) for d in (1, 2, 3)])
    land_flights(first, str(tmp_path / "t"))
    before = files_of(tmp_path / "t")
    land_flights(make_flights({"FL_DATE": date(2017, 5, 1)}, {"FL_DATE": date(2018, 5, 1)}), str(tmp_path / "t"), only_years_in_it=True)
    after = files_of(tmp_path / "t")
    assert {n: b for n, b in after.items() if n.startswith("year=2016")} == {n: b for n, b in before.items() if n.startswith("year=2016")}
    landed = read_landed(spark, str(tmp_path / "t"))
    assert sorted(r.FL_DATE.year for r in landed.collect()) == [2016, 2016, 2016, 2017, 2018]
    land_flights(first, str(tmp_path / "t"))
    assert {r.year for r in read_landed(spark, str(tmp_path / "t")).collect()} == {2016, 2017}


def test_staged_tables_replace_the_old_ones(spark, fixture_flights, tmp_path):
    for flights in (fixture_flights.limit(3), fixture_flights):
        publish_reports(flights, str(tmp_path), staged=True)
    names = {p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")}
    assert names == {"flight_rollup", "avg_delay", "worst_airports", "monthly_trend", "_PUBLISHED"}
    published = spark.read.parquet(str(tmp_path / "avg_delay"))
    assert sorted(published.collect()) == sorted(reports.delay_by_group(fixture_flights).collect())


def test_a_run_that_dies_leaves_the_old_tables_whole(spark, fixture_flights, tmp_path):
    publish_reports(fixture_flights, str(tmp_path), staged=True)
    before = {n: b for n, b in files_of(tmp_path).items()}
    dying = {"monthly_trend": reports.monthly_trend, "avg_delay": lambda f: reports.delay_by_group(f).withColumn("x", F.raise_error(F.lit("dies")))}
    with pytest.raises(Exception, match="dies"):
        publish_reports(fixture_flights.limit(2), str(tmp_path), dying, staged=True)
    left = {n: b for n, b in files_of(tmp_path).items() if not n.startswith("_staging")}
    assert left == before and (tmp_path / "_PUBLISHED").exists()
